"""weftline.sources"""
