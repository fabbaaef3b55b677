"""Field-service analytics on Spark: landed records to job costing, KPIs and checks."""
