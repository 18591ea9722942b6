"""Training-data operators over documents, pages and embeddings.

Nothing outside this subpackage imports it.  Each module holds one operator
with a general interface; ``queries`` holds the thin queries over the test
tables and their SQL.
"""
