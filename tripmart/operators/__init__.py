"""DataFrame -> DataFrame operators.

Vocabulary: *prepared* trips carry every derived column plus the flag
``structurally_valid``; *cells* are additive states (counts and sums) at some
grain.  One valid trip is the finest cell, a monthly rollup a coarser one, and
every report accepts either.
"""
