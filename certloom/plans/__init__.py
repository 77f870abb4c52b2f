"""certloom.plans"""
