"""Training-data operators: packing, secrets, dedup, tokenising, language, PII,
nearest neighbours, quality rules, chat formatting and the n-gram Jaccard join.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its
queries when it is present.
"""
