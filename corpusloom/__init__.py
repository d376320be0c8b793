"""A Spark-native engine that turns scraped web text into a clean, routed, de-duplicated corpus."""
