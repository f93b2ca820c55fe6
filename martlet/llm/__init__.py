"""Operations of a training-data pipeline: packing, near and exact duplicates,
language, toxicity, quality, URL and personal-data filters, tokenizing and
vector search. Nothing outside this subpackage imports it."""
