"""revlake.functions"""
