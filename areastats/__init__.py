"""Small-area statistics on Spark: raw public feeds in, one wide feature row per area out."""
