"""Operations on text corpora, web pages and vectors for training-data pipelines."""
