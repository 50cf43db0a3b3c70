"""factloom: rule-driven evidence resolution and corpus preparation on PySpark."""
