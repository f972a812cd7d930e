"""packloom.functions"""
