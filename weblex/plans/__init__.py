"""weblex.plans"""
