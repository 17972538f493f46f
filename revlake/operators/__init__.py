"""revlake.operators"""
