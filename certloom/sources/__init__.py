"""certloom.sources"""
