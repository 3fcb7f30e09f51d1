"""Operators of a large-scale training-data pipeline (one module each).

packing, jaccard, decontaminate, tokens, toxicity, sharding, secrets, warc,
urls, quality; ``queries`` registers one query per operator and the pipeline.
Nothing outside this subpackage imports it.
"""
