"""Monthly employment series analytics on Spark DataFrames.

Subpackages:
    functions  scalar column expressions (cleaning, coercion, rounding)
    sources    readers, writers and the test-table fixture mapping
    operators  filters, fused seasonal sums, growth windows, ranks, table scope
    plans      the composite reports and the registered query catalog
    streaming  none: the reference job is batch only
"""

__version__ = "0.1.0"
