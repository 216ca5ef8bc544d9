"""Commerce analytics on Spark: one wide order export in, typed layers, reports and models out."""
