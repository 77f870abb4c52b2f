"""certloom.streaming"""
