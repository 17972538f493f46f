"""revlake.plans"""
