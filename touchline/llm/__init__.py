"""Operators for preparing large training corpora.

Every module holds one operator with its own general interface; ``queries`` applies each of
them to the supplied tables. Nothing else in the library imports this package.

=================  ==============================================================
``quality_rules``  weak supervision over voting rules
``token_store``    token ids in range-coded, checksummed blocks
``chunk_dedup``    content-defined chunks deduplicated by digest
``packing``        hierarchical best-fit packing
``ngram_join``     n-gram Jaccard join through MinHash bands
``vector_dedup``   cosine links through collision-counting projections
``fixity``         Merkle audit of WARC archives
``mixing``         time-varying mixture of sources
``secrets_scan``   keyword automaton, anchored patterns, checksums
``pii``            bootstrapped contextual extraction of personal data
``collocations``   phrases scored by marginal counts of their longest windows
``whitening``      embeddings whitened by spectral divide and conquer
``decontaminate``  benchmark windows found by their rarest shingle
=================  ==============================================================
"""
