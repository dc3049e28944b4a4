"""kinfold: record linkage expressed as Spark DataFrame transformations."""
