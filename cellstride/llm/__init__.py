"""Operations on text and vector tables for training data: mixing, deduplication, search, classification, coding."""
