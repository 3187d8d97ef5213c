"""Training-data pipeline operators.

Thirteen operators over document tables (substring and suffix dedup, n-gram join,
quality model and rules, tokenizer, language id, nearest neighbours, secret and
license scans, packing, phrases, spelling variants). Nothing outside this folder imports it; the registered queries
are in ``queries``.
"""
