"""packloom.plans"""
