"""Operations for preparing training data from tables of documents."""
