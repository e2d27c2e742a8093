"""Operations of a training-data pipeline over documents, vectors and web captures.

Each module holds one operator with its own general interface; ``queries``
registers one query per operator over the supplied tables.  Nothing outside this
folder (and ``corpus_pipeline.py``) imports it.
"""
