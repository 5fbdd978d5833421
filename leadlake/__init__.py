"""leadlake: table operators that turn noisy web leads into a curated, queryable catalog on Spark."""
