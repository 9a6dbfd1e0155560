"""pairloom: co-visitation analytics and corpus preparation on PySpark."""
