"""revlake.streaming"""
