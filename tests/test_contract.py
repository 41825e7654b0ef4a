"""Driver contract: entry() smoke, every query key has oracle SQL (or is documented rows-only)."""

import __spark_entry__ as E
from tillroll.plans import registry


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 10
    assert df.columns == ["seller_id", "seller_name", "total_quantity", "total_revenue"]


def test_every_query_has_oracle():
    q, s = registry.all_queries(), registry.all_sql()
    assert set(q) == set(s), set(q) ^ set(s)
    assert len(q) >= 130
    assert set(q) <= set(E.queries()) and set(s) <= set(E.oracle_sql()) <= set(E.queries())


def test_survey_keys_present():
    keys = set(E.queries())
    survey = """src_stage src_landed stream_source csv_load src_json sink_stage sink_dim sink_fact sink_mart stream_land
    project_clients project_sellers project_products ts_normalise conform_purchases fact_purchases display_name
    bucket_day bucket_month bucket_year aov_by_day month_to_date coerce_measures json_parse price_purchases event_json
    fill_defaults lookup_client lookup_product lookup_purchase lookup_seller list_products_by_seller
    list_purchases_filtered latest_year stock_available fact_client_resolve fact_seller_resolve valid_purchases_semi
    orphan_purchases_anti deletable_clients purchases_not_deleted new_clients_unique_email cascade_delete_products
    set_null_missing_dim dedup_clients dedup_sellers dedup_products dedup_purchases
    mart_sales_by_day mart_sales_by_month mart_sales_by_year mart_sales_by_product mart_sales_by_client
    mart_sales_by_seller mart_avg_order_value_by_day mart_unique_clients_per_day mart_unique_products_per_day
    mart_seller_revenue_by_month mart_client_revenue_by_month mart_product_quantity_sold_by_month
    mart_top_products_by_year mart_top_clients_by_year mart_client_purchase_frequency
    report_sales_by_day report_sales_by_month report_sales_by_year report_sales_by_product report_sales_by_client
    report_sales_by_seller report_avg_order_value_by_day report_unique_clients report_unique_products
    report_seller_month report_client_month report_product_month report_products_by_year report_clients_by_year
    report_client_frequency top10_products top10_clients top10_sellers top10_products_latest_year
    top10_clients_latest_year top10_loyal_clients series_sales_day series_sales_month series_sales_year
    series_unique_clients series_unique_products rollup_seller_month rollup_client_month rollup_product_month
    report_row_count page_clients page_products page_purchases page_sellers stream_parse stream_route stream_replay
    validate_clients validate_sellers validate_products validate_purchases audit_constraints classify_purchases
    update_clients update_products update_sellers insert_clients insert_sellers insert_products delete_clients
    delete_products delete_purchases delete_sellers allocate_stock restock update_products_rejected
    update_sellers_rejected deletable_products deletable_sellers email_taken fill_defaults_quantity""".split()
    missing = [k for k in survey if k not in keys]
    assert not missing, missing
