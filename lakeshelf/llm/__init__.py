"""Training-data operators (tokenisation, deduplication, filtering, chat data).

Nothing outside this folder imports it, so it can be removed as a whole.
"""
