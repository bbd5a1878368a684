"""newstape: news and daily-price analytics as lazy Spark DataFrame transformations."""
