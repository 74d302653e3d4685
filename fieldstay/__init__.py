"""Operations analytics for multi-region field-service data, as Spark DataFrame functions."""
