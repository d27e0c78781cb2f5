"""weblex.functions"""
