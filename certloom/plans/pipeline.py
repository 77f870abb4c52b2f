"""End-to-end certificate pipeline (X8) and its stages.

    pages --group by document (page 1's text only)--> client per document --+
      |                                                                     |
      +--join client--> one select: the outcome of each page under its -----+
             client's layouts only, stored once
             |-> page_errors                                            (no shuffle)
             +-> items: explode -> dictionary (distinct texts; their hits broadcast where few)
                        -> one shuffle by document -> ID expansion, last-wins per (doc, id), row numbers
                           (a document of very many IDs: expanded over many tasks, shuffled by ID)
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_blank, pysplit, truthy
from ..operators.dictionary import Dictionary, nullif_empty, substring_hits, token_matches
from ..functions.ids import low_start, render_id
from ..operators.expand import DEFAULT_CHUNK, explode_ids, with_offsets
from ..operators.reduce import last_wins_ids, number_block, number_rows
from ..session import store
from ..sources.sinks import render_errors
from . import messages as C
from .layouts import Steps, centurion_client_outcome, errs, first_integrated_outcome, outcome, sparrow_outcome

# Client keywords, in priority order (the first listed wins).
DEFAULT_KEYWORDS = ("Sparrows", "Centurion", "First Integrated")

ITEM_VALUE_COLS = ["client", "item_description", "model", "swl_value", "swl_unit", "swl_note", "manufacturer",
                   "certificate_no", "previous_inspection", "next_inspection_due_date", "provider_identification",
                   "errors", "errors_text"]


@dataclass(frozen=True)
class Options:
    """``variant``: rule set where the two copies of the rules differ
    (``local`` or ``deployed``): unit lists, the Centurion serial rule and, unless
    ``id_variant`` names one, the Centurion ID chain.  ``id_variant``: by default
    the union of both chains for ``local``, the deployed one for ``deployed``.
    ``compat``: reproduce known defects.  ``rebalance``: spread the chunks of
    large ID ranges over tasks."""
    variant: str = "local"
    id_variant: str | None = None
    compat: bool = False
    chunk_size: int = DEFAULT_CHUNK
    rebalance: bool = True

    def centurion_ids(self) -> str:
        named = {"local": "centurion_local", "deployed": "centurion_deployed"}
        if self.id_variant is None:
            return "centurion_deployed" if self.variant == "deployed" else "centurion"
        return named.get(self.id_variant, self.id_variant)


# ------------------------------------------------------------------ routing
def route_keyword(text, keywords=DEFAULT_KEYWORDS):
    """The first keyword *in list order* contained in the text (case-insensitive)."""
    return F.coalesce(_first_keyword(text, keywords, keywords), F.lit(None).cast("string"))


def _first_keyword(text, keywords, values):
    """The value beside the first keyword contained in the text."""
    low = F.lower(text)
    return F.coalesce(*[F.when(low.contains(k.lower()), F.lit(v)) for k, v in zip(keywords, values, strict=True)], F.lit(None))


def route_documents(pages: DataFrame, keywords=DEFAULT_KEYWORDS) -> DataFrame:
    """P1+P2+P3: page 1 of each document decides its client.
    Output (doc_id, client, blank), one row per document; ``blank`` is null for
    a document without a page 1."""
    first, names = F.col("page_no") == 1, sorted(set(keywords), key=lambda k: k.encode())
    # a keyword travels as its place in their order: a maximum of texts would be sorted for, one of numbers is hashed
    place = _first_keyword(F.col("text"), keywords, [names.index(k) for k in keywords]).cast("int")
    facts = pages.select("doc_id", F.when(first, place).alias("client"),
                         F.when(first, is_blank(F.col("text"))).alias("blank"))
    found = facts.groupBy("doc_id").agg(F.max("client").alias("client"), F.max("blank").alias("blank"))
    named = F.get(F.array(*[F.lit(k) for k in names]).cast("array<string>"), F.col("client"))
    return found.select("doc_id", named.alias("client"), "blank")


def document_status(routes: DataFrame, run_date: str | None = None) -> DataFrame:
    """K6: one row per document: Success when a client was recognised, else
    Failure with a reason."""
    ok = F.coalesce(~F.col("blank"), F.lit(False)) & F.col("client").isNotNull()
    return routes.select(
        "doc_id", F.when(~F.col("blank"), F.col("client")).alias("client"),
        F.when(ok, F.lit(C.STATUS_SUCCESS)).otherwise(F.lit(C.STATUS_FAILURE)).alias("status"),
        F.when(F.col("blank").isNull(), F.lit(C.REASON_NO_FIRST_PAGE)).when(F.col("blank"), F.lit(C.REASON_BLANK))
        .when(F.col("client").isNull(), F.lit(C.REASON_NO_CLIENT)).alias("reason"),
        (F.lit(run_date) if run_date else F.current_date().cast("string")).alias("run_date"))


# ------------------------------------------------------------------ extraction
def with_candidates(pages: DataFrame, opts: Options = Options(), client_col: str | None = None) -> DataFrame:
    """Add one outcome column per client layout family (row-local); with
    ``client_col`` a page is only read under its own client's layouts."""
    return _candidate_steps(pages.sparkSession.sparkContext.applicationId, opts, client_col).apply(pages)


@lru_cache(maxsize=8)
def _candidate_steps(application: str, opts: Options, client_col: str | None) -> Steps:
    def gate(name):
        return None if client_col is None else F.coalesce(F.col(client_col) == name, F.lit(False))
    d = sparrow_outcome(Steps(()), "_o_sparrows", opts.variant, gate=gate("Sparrows"))
    d = centurion_client_outcome(d, "_o_centurion", opts.centurion_ids(), opts.variant, gate=gate("Centurion"))
    return first_integrated_outcome(d, "_o_first_integrated", opts.variant, opts.compat,
                                    gate=gate("First Integrated"))


def _pick(client_col):
    c = F.col(client_col)
    return (F.when(c == "Sparrows", F.col("_o_sparrows")).when(c == "Centurion", F.col("_o_centurion"))
            .when(c == "First Integrated", F.col("_o_first_integrated")).otherwise(outcome()))


def layout_outcome(pages: DataFrame, client: str, opts: Options = Options()) -> DataFrame:
    """Outcome of every page under one known client's layouts only."""
    d = pages.withColumn("client", F.lit(client))
    if client == "Sparrows":
        d = sparrow_outcome(d, "outcome", opts.variant)
    elif client == "Centurion":
        d = centurion_client_outcome(d, "outcome", opts.centurion_ids(), opts.variant)
    elif client == "First Integrated":
        d = first_integrated_outcome(d, "outcome", opts.variant, opts.compat)
    else:
        raise ValueError(f"unknown client {client!r}")
    return d.select("doc_id", "page_no", "client", "outcome")


def page_outcome(pages: DataFrame, client_col: str = "client", opts: Options = Options()) -> DataFrame:
    """One row per page with ``outcome struct<items, error>`` for a known client."""
    d = with_candidates(pages, opts, client_col)
    return d.select("doc_id", "page_no", client_col, _pick(client_col).alias("outcome"))


def one_outcome_per_page(outcomes: DataFrame) -> DataFrame:
    """Stored outcomes with one row per page.  Pages that arrived twice are found on the keys alone; only where
    there are any is an outcome chosen, by its content, whatever the order of the rows."""
    keys = outcomes.groupBy("doc_id", "page_no").count().where(F.col("count") > 1)
    if keys.isEmpty():
        return outcomes
    tagged = outcomes.withColumn("_h", F.xxhash64(F.to_json("outcome"), "client"))
    return tagged.groupBy("doc_id", "page_no").agg(F.max_by(F.struct("client", "outcome"), "_h").alias("_o")).select(
        "doc_id", "page_no", "_o.client", "_o.outcome")


def page_errors_of(outcomes: DataFrame) -> DataFrame:
    """One row per page with an error."""
    return outcomes.where(F.col("outcome.error").isNotNull()).select(
        "doc_id", "page_no", "client", F.col("outcome.error").alias("error"))


def raw_items_of(outcomes: DataFrame) -> DataFrame:
    return outcomes.select("doc_id", "page_no", "client", F.inline("outcome.items"))


def lookup_texts(outcomes: DataFrame) -> DataFrame:
    """(_text, _sub): the distinct texts that any item needs looked up, and whether one needs the substring rule.
    Three fields of the stored outcomes are read."""
    f = F.explode(F.arrays_zip(*[F.col(f"outcome.items.{n}").alias(n) for n in ("lookup_desc", "lookup_mode", "maker_desc")]))
    return _texts(outcomes.select(f.alias("_i")).select("_i.*"))


def _texts(items: DataFrame) -> DataFrame:
    both = F.array(F.struct(F.col("lookup_desc").alias("_text"), F.coalesce(
        F.col("lookup_mode") == "substring", F.lit(False)).alias("_sub")),
        F.struct(F.col("maker_desc").alias("_text"), F.lit(False).alias("_sub")))
    return items.select(F.inline(both)).where(F.col("_text").isNotNull()).groupBy("_text").agg(F.max("_sub").alias("_sub"))


def _lookup_table(texts: DataFrame, dictionary: Dictionary) -> DataFrame:
    """Raw dictionary hits for every distinct text any item needs looked up."""
    hits = token_matches(texts.select("_text"), "_text", dictionary)
    return hits.join(substring_hits(texts.where("_sub").select("_text"), "_text", dictionary), "_text", "left")


#: A stored lookup result of at most so many texts and characters is broadcast; a larger one is joined by shuffles.
BROADCAST_TEXTS, BROADCAST_CHARACTERS = 100_000, 1 << 23


def finish_items(items: DataFrame, dictionary: Dictionary, override: bool = True,
                 texts: DataFrame | None = None) -> DataFrame:
    """Dictionary lookups per mode, then the final error list (A4).  ``texts`` (:func:`lookup_texts` of stored
    outcomes): the lookup result is stored and counted, and where it is small no item is shuffled."""
    if texts is None:
        lk, small = _lookup_table(_texts(items), dictionary), False
    else:
        lk = store(_lookup_table(store(texts, "texts"), dictionary), "lookup")
        n, characters = lk.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("_text")), F.lit(0))).first()
        small = n <= BROADCAST_TEXTS and characters <= BROADCAST_CHARACTERS
    # all that follows from a text alone is made once a text
    mc = F.col("m_canonical")
    if override:
        mc = F.when((F.lower(mc) == "miller") & F.array_contains(F.array_distinct(pysplit(F.lower("_text"))), "weblift"),
                    F.lit("Miller Weblift")).otherwise(mc)
    maker = F.when(truthy(mc), mc).when(truthy("d_manufacturer"), F.col("d_manufacturer"))
    d = lk.select(F.col("_text").alias("_dk"), maker.alias("_tm"), nullif_empty(F.col("d_model")).alias("_dm"),
                  nullif_empty(F.col("_s.manufacturer")).alias("_sm"), nullif_empty(F.col("_s.model")).alias("_smod"))
    m = lk.select(F.col("_text").alias("_mkey"), nullif_empty(F.col("m_keyword")).alias("_maker_kw"))
    # in a shuffle, rows without a text to look up must not meet in one task: they get keys of their own
    def spread(text):
        own = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64("doc_id", "page_no", "row_no"), F.lit(4096)).cast("string"))
        return F.col(text) if small else F.coalesce(F.col(text), own)
    if small:
        d, m = F.broadcast(d), F.broadcast(m)
    j = items.withColumn("_dk", spread("lookup_desc")).withColumn("_mkey", spread("maker_desc"))
    j = j.join(d, "_dk", "left").join(m, "_mkey", "left").drop("_dk", "_mkey")
    mode = F.col("lookup_mode")
    manufacturer = (F.when(mode == "token", F.col("_tm")).when(mode == "keyword", F.col("_maker_kw"))
                    .when(mode == "substring", F.col("_sm")).otherwise(F.col("manufacturer")))
    model = (F.when(mode.isin("token", "model_only", "keyword"), F.col("_dm")).when(mode == "substring", F.col("_smod"))
             .otherwise(F.col("model")))
    j = j.withColumn("manufacturer", manufacturer).withColumn("model", model)
    dict_errs = errs((F.col("dict_errors") & (mode != "model_only") & F.col("manufacturer").isNull(), C.MANUFACTURER_NOT_FOUND), (F.col("dict_errors") & F.col("model").isNull(), C.MODEL_NOT_FOUND))
    base = F.concat(F.col("err_head"), dict_errs, F.col("err_tail"))
    errors = F.concat(base, F.col("suffix_always"),
                      F.when(F.size(base) > 0, F.col("suffix_if_any")).otherwise(F.array().cast("array<string>")))
    # the text is made once an item, not once an ID
    j = j.withColumn("errors", errors).withColumn("errors_text", render_errors(F.col("errors")))
    return j.drop("_tm", "_dm", "_sm", "_smod", "_maker_kw", "err_head", "err_tail", "dict_errors",
                  "suffix_always", "suffix_if_any", "lookup_mode", "maker_desc")


#: IDs that one task expands at a time; a document that names more is dealt over many tasks.
CLUSTER_IDS = 1 << 19


def document_weights(outcomes: DataFrame) -> DataFrame:
    """(doc_id, _n): the number of IDs that each document's items name, by arithmetic (nothing is expanded)."""
    def named(segs):
        return F.aggregate(segs, F.lit(0.0), lambda a, g: a + F.greatest(g["n"], F.lit(0)).cast("double"))
    n = F.aggregate(F.col("outcome.items.id_segments"), F.lit(0.0), lambda a, segs: a + F.coalesce(named(segs), F.lit(0.0)))
    return outcomes.select("doc_id", n.alias("_n")).groupBy("doc_id").agg(F.sum("_n").alias("_n"))


def meeting_documents(outcomes: DataFrame, buckets: int | None = None) -> DataFrame:
    """(doc_id): the documents in which an ID of one segment may be one of another, unlike segment too, by arithmetic
    (nothing is expanded).  In all others a segment is named once or, as it is, several times.

    An ID that ends in its number is told by the text before its last digits and by these digits' value: segments
    with different texts, or with the same one and ranges apart, have no ID in common.  Whatever cannot be told so
    (text after the number, digits before it, very long numbers) counts as meeting where it is not alone."""
    g = F.col("_g")
    segs = outcomes.where(F.col("doc_id").isNotNull()).select("doc_id", F.explode("outcome.items.id_segments").alias(
        "_segs")).select("doc_id", F.explode("_segs").alias("_g")).where(g["n"] > 0)
    segs = segs.repartition(buckets, "doc_id") if buckets else segs.repartition("doc_id")
    segs = segs.select("doc_id", *[g[n].alias(n) for n in SEGMENT]).distinct()
    text = F.rtrim("prefix", F.lit("0123456789"))
    digits = F.col("prefix").substr(F.length(text) + 1, F.length("prefix"))
    low = F.when(F.col("start").isNotNull(), F.when(digits == "", low_start(F.col("start"), F.col("n")))).when(
        digits == "", F.lit(-1).cast("bigint")).when(F.length(digits) <= 18, digits.try_cast("bigint"))
    segs = segs.select("doc_id", text.alias("_t"), low.alias("_lo"), F.col("n").alias("_n"), (
        text.isNull() | F.coalesce(F.col("suffix") != "", F.lit(True))).alias("_odd"))
    before = Window.partitionBy("doc_id", "_t").orderBy("_lo").rowsBetween(Window.unboundedPreceding, -1)
    high = F.coalesce(F.col("_lo") + F.col("_n") - 1, F.lit((1 << 63) - 1))
    segs = segs.withColumn("_before", F.max(high).over(before))
    meets = F.when(F.col("_before").isNotNull(), F.coalesce(F.col("_before") >= F.col("_lo"), F.lit(True))).otherwise(False)
    by_doc = segs.groupBy("doc_id").agg(F.max(meets).alias("_m"), F.max("_odd").alias("_odd"), F.count(F.lit(1)).alias("_c"))
    return by_doc.where(F.col("_m") | (F.col("_odd") & (F.col("_c") > 1))).select("doc_id")


#: So many meeting documents are broadcast; more are joined by shuffles (none over buckets).
BROADCAST_DOCUMENTS = 100_000


def expand_and_reduce(items: DataFrame, opts: Options = Options(), weights: DataFrame | None = None,
                      numbered: bool = False, buckets: int | None = None, outcomes: DataFrame | None = None) -> DataFrame:
    """ID expansion, then last-wins per (doc_id, id_number); ``numbered`` adds ``place_no``, each item's place in its
    document in first-seen order, from 1.

    ``weights`` (:func:`document_weights`): documents of up to ``CLUSTER_IDS`` IDs are brought together once, before
    the expansion, and expanded, reduced and numbered where they are; only the larger ones are expanded over many
    tasks and shuffled by ID.  Without it all are.  ``outcomes``, where these are stored in buckets: of
    most documents only segments are sorted, not IDs (:func:`expand_apart`)."""
    if weights is None:
        return _spread(items, opts, numbered)
    total, largest = weights.agg(F.coalesce(F.sum("_n"), F.lit(0.0)), F.coalesce(F.max("_n"), F.lit(0.0))).first()
    if largest <= CLUSTER_IDS:
        return _in_place(items, outcomes, total, numbered, buckets)
    large = store(weights.where(F.col("_n") > CLUSTER_IDS).select("doc_id", "_n"), "large")  # under total / CLUSTER_IDS rows
    small_total = total - large.agg(F.sum("_n")).first()[0]
    keys = F.broadcast(large.select("doc_id"))
    out = _in_place(items.join(keys, "doc_id", "left_anti"), outcomes and outcomes.join(keys, "doc_id", "left_anti"),
                    small_total, numbered, buckets)
    return out.unionByName(_spread(store(items.join(keys, "doc_id", "left_semi"), "large"), opts, numbered).select(
        *out.columns))


def _in_place(items: DataFrame, outcomes: DataFrame | None, total: float, numbered: bool, buckets: int | None) -> DataFrame:
    """:func:`meeting_documents` by :func:`expand_in_place`, all others by :func:`expand_apart`."""
    if outcomes is None:
        return expand_in_place(items, total, numbered, buckets)
    meeting = store(meeting_documents(outcomes, buckets), "meeting", buckets)
    n = meeting.count()
    keys = F.broadcast(meeting) if n <= BROADCAST_DOCUMENTS else meeting.hint("shuffle_hash")
    apart = expand_apart(items.join(keys, "doc_id", "left_anti") if n else items, total, numbered, buckets)
    if not n:
        return apart
    return apart.unionByName(expand_in_place(items.join(keys, "doc_id", "left_semi"), total, numbered, buckets))


PLACE = ["page_no", "table_no", "row_no"]
SEGMENT = ["prefix", "start", "n", "suffix", "pad"]


def _by_document(items: DataFrame, total: float, buckets: int | None, *values) -> DataFrame:
    """Unexpanded items, together by document; those of outcomes in ``buckets`` by document are where they belong,
    unless these are too few for the IDs: no shuffle."""
    needed = int(total // CLUSTER_IDS) + 1
    tasks = buckets if buckets and buckets >= needed else max(
        int(items.sparkSession.conf.get("spark.sql.shuffle.partitions")), needed)
    return items.where(F.col("doc_id").isNotNull()).select("doc_id", *PLACE, "id_segments", *values).repartition(
        tasks, "doc_id")


def expand_apart(items: DataFrame, total: float, numbered: bool = False, buckets: int | None = None) -> DataFrame:
    """Documents whose unlike segments have no ID in common (:func:`meeting_documents`): a segment wins or loses as a
    whole, so only segments are sorted, and an ID's place follows from the counts before its segment."""
    d = _by_document(items, total, buckets, F.struct(*ITEM_VALUE_COLS).alias("_v"))
    d = d.select("doc_id", *PLACE, "_v", F.posexplode(with_offsets(F.col("id_segments"))).alias("_seg", "_s"))
    d = d.select("doc_id", *PLACE, "_v", "_seg", F.col("_s.offset").alias("_off"), *[
        F.col(f"_s.g.{n}").alias(n) for n in SEGMENT]).where("n > 0")
    same = Window.partitionBy("doc_id", *SEGMENT).orderBy(*PLACE, "_seg")
    d = d.select("*", F.first(F.struct(*PLACE, "_seg", "_off")).over(same).alias("_first"),
                 F.lead(F.lit(1)).over(same).alias("_later")).where(F.col("_later").isNull())
    if numbered:
        before = Window.partitionBy("doc_id").orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)
        d = d.withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0).cast("bigint")))
    d = d.select("*", low_start(F.col("start"), F.col("n")).alias("_low"), F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.col("n") - 1)).alias("_i"))  # at most CLUSTER_IDS of them
    first = F.struct(*[F.col(f"_first.{n}").alias(n) for n in PLACE], (F.col("_first._off") + F.col("_i")).alias("id_idx"))
    return d.select("doc_id", render_id(F.struct(*SEGMENT), F.col("_i"), F.col("_low")).alias("id_number"),
                    first.alias("first_pos"), "_v.*",
                    *([(F.col("_before") + F.col("_i") + 1).alias("place_no")] if numbered else []))


def expand_in_place(items: DataFrame, total: float, numbered: bool = False, buckets: int | None = None) -> DataFrame:
    """One shuffle, of unexpanded items by document; the IDs meet, lose to later ones and get their values in windows
    within the document.  The first ID of an item carries its values, so that rows in a sort are narrow."""
    d = _by_document(items, total, buckets, F.struct(*ITEM_VALUE_COLS).alias("_v"))
    x = explode_ids(d, "id_segments", segment_col="_seg").withColumn("_v", F.when(F.col("id_idx") == 0, F.col("_v")))
    of_id = Window.partitionBy("doc_id", "id_number").orderBy(*PLACE, "_seg")
    x = x.select("*", F.first(F.struct(*PLACE, "id_idx")).over(of_id).alias("first_pos"),
                 F.lead(F.lit(1)).over(of_id).isNull().alias("_last")).where(F.col("_last") | (F.col("id_idx") == 0))
    if numbered:
        x = x.withColumn("place_no", F.row_number().over(Window.partitionBy("doc_id").orderBy(
            F.when(F.col("_last"), 0).otherwise(1), "first_pos")).cast("bigint"))
    of_item = Window.partitionBy("doc_id", *PLACE).orderBy("id_idx")
    x = x.withColumn("_v", F.first("_v").over(of_item)).where("_last")
    return x.select("doc_id", "id_number", "first_pos", "_v.*", *(["place_no"] if numbered else []))


def _spread(items: DataFrame, opts: Options, numbered: bool) -> DataFrame:
    """Documents of any size: the IDs are expanded over many tasks and meet by (doc_id, id_number)."""
    place = ["doc_id", "page_no", "table_no", "row_no"]
    x = explode_ids(items.select(*place, "id_segments"), "id_segments", chunk_size=opts.chunk_size,
                    rebalance_cols=place if opts.rebalance else None, segment_col="segment")
    out = last_wins_ids(x, items, ITEM_VALUE_COLS)
    if not numbered:
        return out
    return number_rows(store(out, "items"), "doc_id", "first_pos", "place_no", block=number_block(), stored=True)


def extract(pages: DataFrame, dictionary: Dictionary, opts: Options = Options(), keywords=DEFAULT_KEYWORDS,
            materialize: bool = True, numbered: bool = False):
    """Batch entry: returns (items, page_errors, status) DataFrames.

    ``materialize`` writes the routes and the compact page outcomes, in buckets by document, once each to the
    checkpoint folder (``spark.checkpoint.dir``), and the small results that later steps are planned by;
    without it the plan stays lazy (and re-reads the input per consumer).  ``numbered``: items have their
    ``place_no``."""
    stored = store if materialize else (lambda df, name, buckets=None: df)
    buckets = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")) if materialize else None
    routes = stored(route_documents(pages, keywords), "routes")
    ok = routes.where(~F.col("blank") & F.col("client").isNotNull()).select("doc_id", "client")
    outcomes = one_outcome_per_page(stored(page_outcome(pages.join(ok, "doc_id"), "client", opts), "outcomes", buckets))
    return (items_of(outcomes, dictionary, opts, materialize, numbered, buckets), page_errors_of(outcomes),
            document_status(routes))


def items_of(outcomes: DataFrame, dictionary: Dictionary, opts: Options = Options(), stored: bool = True,
             numbered: bool = False, buckets: int | None = None) -> DataFrame:
    """The items of page outcomes; ``stored``: these are stored, so that they may be read several times, in
    ``buckets`` by document if that is given."""
    finished = finish_items(raw_items_of(outcomes), dictionary, texts=lookup_texts(outcomes) if stored else None)
    return expand_and_reduce(finished, opts, document_weights(outcomes) if stored else None, numbered, buckets,
                             outcomes if stored and buckets else None)
