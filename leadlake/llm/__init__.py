"""Training-data operators: tokenisation, quality rules, archives, mixing and the dedup family.

Nothing outside this subpackage imports it; ``leadlake.llm.queries`` registers its queries.
"""
