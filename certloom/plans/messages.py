"""Message texts.

Fixed values: the item- and page-level messages the certificate rules emit
(texts must stay exactly as they are, users filter on them).  Where the rules
would only have printed a Python exception, a stable message of ours is used
instead (marked "ours").
"""

# Item-level messages.
MANUFACTURER_NOT_FOUND = "Manufacturer not found"
MODEL_NOT_FOUND = "Model not found"
SPARROW_NO_DESCRIPTION = ("Description not found in the page. Item Description, Manufacturer, Model columns are "
                          "left empty")
SWL_VALUE_NOT_FOUND = "SWL Value not found"
SWL_UNIT_NOT_FOUND = "SWL Unit not found"
SWL_NOT_FOUND = "SWL not found in the page"
SWL_NOT_FOUND_DEPLOYED = "SWL not found in the page."
SWL_UNIT_NOT_FOUND_C = "SWL Unit not Found"
SWL_NOT_FOUND_C = "SWL not found in this page."
CERTIFICATE_NO_NOT_FOUND = "Certificate no not found"
PREVIOUS_INSPECTION_NOT_FOUND = "Previous Inspection not found"
PROVIDER_NOT_FOUND = "Provider Identification not found"
NEXT_DUE_NOT_FOUND = "Next Inspection Due Date not found"
ID_EXPANSION_FAILED = ("Error in extracting identification numbers. So, appending the identification number as "
                       "found in the page")
PAGE_NO_PREFIX = "page no: "
ID_NUMBER_NOT_FOUND = "ID Number not found"
DESCRIPTION_NOT_FOUND = "Description not found"
PREVIOUS_NOT_FOUND_FI = "Previous Inspection not found"
CERTIFICATE_NUMBER_NOT_FOUND = "Certificate Number not found"
ID_NUMBER_NOT_FOUND_FI3 = "Id Number not found"
DECLARATION_NOT_FOUND = "Date of Declaration not found"
FOR_ID_PREFIX = "for ID: "

# Page-level messages.
NO_IDS_ON_PAGE = "No identification numbers are found in the page. So, the page is not processed."
NO_TEXT_ON_PAGE = "No text found on page. probably it's an image. So, the page is not processed."
FI_NO_TABLES_A = " No tables found on page "
FI_NO_TABLES_B = ". Skipping..."
FI_UNRECOGNISED = "No recognized table found on page "

# Ours: stable replacements for exception texts.
PAGE_SHAPE_ERROR = "Error: the page grid does not have the expected rows and cells occurred while processing the page:"
CENTURION_NO_SERIALS = "Error: no description or serial numbers found occurred while processing the page:"
CENTURION_LABELS_MISSING = ("Error: report number, date of examination or customer reference missing occurred "
                            "while processing the page:")
ID_EXPRESSION_ERROR = "Error: the identification numbers could not be expanded occurred while processing the page:"

# Document level.
STATUS_SUCCESS = "Success"
STATUS_FAILURE = "Failure"
REASON_BLANK = "blank first page"
REASON_NO_CLIENT = "no client keyword"
REASON_NO_FIRST_PAGE = "no first page"
