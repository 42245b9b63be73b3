"""The batch stages and the screens, put together from the operators.

``preprocess`` and ``train`` write tables; ``analyse`` returns DataFrames whose
actions are the caller's. ``screens`` run one job for a summary that what they
return is taken from.
"""
