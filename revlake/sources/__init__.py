"""revlake.sources"""
