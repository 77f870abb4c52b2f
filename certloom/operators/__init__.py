"""certloom.operators"""
