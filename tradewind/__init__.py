"""Category-level market signals as Spark jobs: feeds, cleaning, scoring, read models, queries."""
