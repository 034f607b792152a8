"""Training-data operators over whole text corpora.

One module per operator (quality, bpe, suffix_index, decontam, parity_join, ego_join, token_counts,
substring, pseudo_lm, toxicity); ``queries`` registers them. Nothing outside this package imports it.
"""
