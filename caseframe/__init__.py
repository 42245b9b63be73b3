"""caseframe: disease surveillance analytics as PySpark DataFrame functions.

Sub-packages, from the bottom up:

``functions``  column expressions (casts, rates, priority bands, map colours)
``sources``    readers, writers and the working folder for cut lineage
``operators``  DataFrame in, DataFrame out; no action inside
``plans``      the batch stages and screens, put together from the operators
"""
