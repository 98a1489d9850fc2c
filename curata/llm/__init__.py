"""Training-data operators: language ID, tokenisation, near-duplicates, decontamination,
personal data, secrets, page extraction, toxicity, nearest neighbours and token files.

Nothing outside this folder imports it.  Each operator module has a general DataFrame
interface; ``queries.py`` holds the thin ``opN_<name>`` queries over the given tables.
"""
