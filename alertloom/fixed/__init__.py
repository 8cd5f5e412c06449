"""Label maps, record texts, prompts and document texts.

Nothing in this package computes anything. Every value here must be exactly as
written for results to agree with tables produced before this library existed.
"""
