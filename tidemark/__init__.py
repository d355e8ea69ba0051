"""tidemark: a customer and revenue warehouse on PySpark.

Raw CRM / ERP / web tables -> 14 staging models -> 5 intermediate
models -> 3 marts (churn risk, revenue health, sales funnel), curated
queries and rollups over the marts, and 95 data-quality checks. Every
step is a DataFrame transformation that Catalyst plans; see README.md.
"""
