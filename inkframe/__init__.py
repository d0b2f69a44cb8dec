"""inkframe: scene-text indexing, retrieval and packaging as Spark DataFrame transformations."""
