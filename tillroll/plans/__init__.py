"""The pipeline stages, composed from operators and column functions.

clean    cleaned_sales, cleaning_metrics and the single steps (dedup, fill, filter, casts, derived columns)
enrich   enriched_sales, left_join_customers, fill_customer_defaults, add_tenure, enrichment_metrics,
         tier_distribution
metrics  daily_sales, product_performance, sorted_products, top_product, regional_performance,
         customer_insights, summary_metrics, customer_summary
quality  ingest_metrics, row_count (stage receipts)
publish  run_all: every stage written as a table and read back, plus its run metadata
"""
