"""Operators of a training-data pipeline, each a function over DataFrames.

========== ============================================================
chat       chat formatting with a grammar round trip (native)
spbpe      SentencePiece BPE with seeded merge dropout
tokenfile  token-id blocks with Elias-Fano document boundaries
packing    sequences packed along a Hilbert curve
langid     language ID by cross-parsing with suffix automata
toxicity   boosted trees over dense features, isotonic calibration
topk       exact top-k with block-at-a-time pruning
quality    threshold table compiled into one projection (native)
neardup    ProbMinHash, banding and verification
pii        detected entities replaced by keyed surrogates
divergence audit of sources by partial Arrow counts
kneserney  Kneser-Ney model in mapped sorted arrays
hardneg    hard negatives by segment summaries
========== ============================================================

Nothing else in the library imports this subpackage.
"""
