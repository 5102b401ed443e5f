"""Operations for preparing training text: filters, near-duplicate search, tokenizing and packing."""
