"""One order, part, supplier, customer and user each hold a large part of all rows."""

import pytest

from verify.check import compare, connect
from verify.registry import CASES

pytestmark = pytest.mark.tables

HOT = {
    "lineitem": "select case when i % 3 = 0 then 7 else l_orderkey end as l_orderkey, "
    "case when i % 3 = 1 then 11 else l_partkey end as l_partkey, case when i % 5 < 2 then 5 else l_suppkey end as l_suppkey, "
    "* exclude (l_orderkey, l_partkey, l_suppkey, i) from (select *, row_number() over () as i from t)",
    "orders": "select * replace (case when o_orderkey % 3 = 0 then 17 else o_custkey end as o_custkey) from t",
    "events": "select * replace (case when event_id % 3 = 0 then 1 else user_id end as user_id) from t",
}
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
CHOSEN = (
    "a02_credit_rows a02_credit_arrays a03_select_by_id b10_one_per_key b10_latest_per_key b15_clean d03_uniqueness_lines "
    "d06_references d10_quality_report d14_outliers_lines e12_all_rankings f01_genres_and_cast_text g05_franchise_against_standalone "
    "g08_genre_performance g19_director_metrics g19_director_members g20_franchise_metrics g25_collaborations g25_collaboration_members g27_line_matrix h05_line_price_histogram "
    "h14_rating_by_genre h21_line_price_boxes h24_rating_heatmap"
).split()


@pytest.fixture(scope="module")
def skewed(folder, tmp_path_factory):
    import duckdb

    target = tmp_path_factory.mktemp("skewed")
    connection = duckdb.connect()
    for name in TABLES:
        query = HOT.get(name, "select * from t").replace("from t", f"from '{folder}/{name}.parquet'")
        connection.execute(f"copy ({query}) to '{target}/{name}.parquet' (format parquet)")
    return str(target)


@pytest.mark.parametrize("name", CHOSEN)
def test_skewed_tables_give_whole_results(spark, skewed, name):
    case = next(c for c in CASES if c.name == name)
    problem, rows = compare(spark, connect(skewed), case, skewed)
    assert problem is None and rows > 0
