"""JDBC extract/load logic with Spark's JDBC calls stubbed (no database is started)."""

import pytest
from pyspark.sql import DataFrameReader

from lakecart.schemas import INSERT_ORDER, spec
from lakecart.sources import jdbc


def _stub_reader(monkeypatch, spark, bounds):
    calls = []
    cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spec("orders").bronze_schema().fields)

    def fake_jdbc(self, url, table, column=None, lowerBound=None, upperBound=None, numPartitions=None,
                  predicates=None, properties=None):
        calls.append(dict(table=table, column=column, lower=lowerBound, upper=upperBound, parts=numPartitions,
                          props=properties))
        if "MIN(" in table:
            return spark.createDataFrame([bounds], "lo bigint, hi bigint, n bigint")
        return spark.createDataFrame([], cols)

    monkeypatch.setattr(DataFrameReader, "jdbc", fake_jdbc)
    return calls


def test_extract_reads_primary_key_ranges(spark, monkeypatch):
    calls = _stub_reader(monkeypatch, spark, (10, 500, 200))
    df = jdbc.extract_jdbc(spark, "jdbc:x://db", "orders", {"user": "u"}, num_partitions=16)
    assert df.columns == spec("orders").column_names
    assert "MIN(order_id)" in calls[0]["table"] and "MAX(order_id)" in calls[0]["table"]
    read = calls[1]
    assert (read["table"], read["column"], read["lower"], read["upper"], read["parts"]) == \
        ("orders", "order_id", 10, 501, 16)
    assert read["props"]["fetchsize"] == "10000" and read["props"]["user"] == "u"


def test_extract_empty_table_reads_without_ranges(spark, monkeypatch):
    calls = _stub_reader(monkeypatch, spark, (None, None, 0))
    jdbc.extract_jdbc(spark, "jdbc:x://db", "orders", {})
    assert calls[1]["column"] is None and calls[1]["parts"] is None


def test_unknown_table_refused(spark):
    import pytest
    with pytest.raises(ValueError):
        jdbc.extract_jdbc(spark, "jdbc:x://db", "foo", {})


def _stub_loads(monkeypatch):
    events = []
    monkeypatch.setattr(jdbc, "run_sql", lambda spark, url, props, sql: events.extend(("sql", s.split("(")[0].strip()) for s in sql))
    monkeypatch.setattr(jdbc, "load_jdbc", lambda df, url, t, props, **kw: events.append(("insert", t)))
    monkeypatch.setattr(jdbc, "load_row_count", lambda s, url, t, props: 0)
    monkeypatch.setattr(jdbc, "last_id", lambda s, url, t, props: 100)
    return events


def test_truncate_empties_before_parents_are_inserted_first(spark, monkeypatch):
    events = _stub_loads(monkeypatch)
    jdbc.load_all({t: spark.range(1) for t in ("orders", "users", "order_items")}, "jdbc:x://db", {}, mode="truncate")
    assert events[0] == ("sql", "TRUNCATE TABLE order_items, orders, users RESTART IDENTITY CASCADE")
    inserts = [t for kind, t in events if kind == "insert"]
    assert inserts == [t for t in INSERT_ORDER if t in inserts] == ["users", "orders", "order_items"]
    assert events[-1][1].startswith("SELECT setval")


def test_fresh_recreates_children_first(spark, monkeypatch):
    events = _stub_loads(monkeypatch)
    jdbc.load_all({t: spark.range(1) for t in ("categories", "products")}, "jdbc:x://db", {}, mode="fresh")
    assert [e for e in events if "TABLE" in e[1]] == [
        ("sql", "DROP TABLE IF EXISTS products CASCADE"), ("sql", "DROP TABLE IF EXISTS categories CASCADE"),
        ("sql", "CREATE TABLE categories"), ("sql", "CREATE TABLE products")]


def test_append_gives_out_new_ids(spark, monkeypatch):
    events, sent = _stub_loads(monkeypatch), {}
    monkeypatch.setattr(jdbc, "load_jdbc", lambda df, url, t, props, **kw: sent.update({t: df}))
    users = spark.createDataFrame([(1, "a@x.y"), (2, "b@x.y")], "user_id bigint, email string")
    jdbc.load_all({"users": users}, "jdbc:x://db", {}, mode="append", run_id="r")
    assert sorted(r.user_id for r in sent["users"].collect()) == [101, 102]
    assert not any("TABLE" in s for _, s in events)
    import pytest
    with pytest.raises(ValueError):  # without a run id keys could collide
        jdbc.load_all({"users": users}, "jdbc:x://db", {}, mode="append")


def test_ranges_follow_rows_and_width():
    assert jdbc.extract_partitions("orders", 0) == 1
    assert jdbc.extract_partitions("product_reviews", 10**9) > 10 * jdbc.extract_partitions("order_items", 10**9) > 1000


def test_created_tables_fill_in_and_protect_like_the_source():
    of = {t: jdbc.create_table_sql(t) for t in INSERT_ORDER}
    line = lambda t, c: next(x.strip().rstrip(",") for x in of[t].splitlines() if x.strip().startswith(c + " "))
    assert line("products", "price") == "price NUMERIC(10,2) NOT NULL CHECK (price >= 0)"
    assert line("products", "category_id").endswith("REFERENCES categories (category_id) ON DELETE RESTRICT")
    assert line("products", "inventory_quantity") == "inventory_quantity INT NOT NULL DEFAULT 0 CHECK (inventory_quantity >= 0)"
    assert line("orders", "currency") == "currency TEXT NOT NULL DEFAULT 'USD'"
    assert line("orders", "order_date") == "order_date TIMESTAMPTZ NOT NULL DEFAULT NOW()"
    assert line("orders", "total_amount") == "total_amount NUMERIC(12,2) NOT NULL"
    assert line("orders", "user_id").endswith("ON DELETE CASCADE") and line("order_items", "product_id").endswith("ON DELETE RESTRICT")
    assert line("order_items", "unit_price").startswith("unit_price NUMERIC(10,2)") and line("order_items", "total_price").startswith("total_price NUMERIC(12,2)")
    assert all(s.count("DEFAULT NOW()") == sum(k in ("ts", "date") for _, k in spec(t).columns) for t, s in of.items())
    assert sum(s.count("ON DELETE CASCADE") for s in of.values()) == 8 and sum(s.count("ON DELETE RESTRICT") for s in of.values()) == 3


def test_the_password_comes_from_a_file(tmp_path):
    from lakecart import cli
    secret = tmp_path / "secret"
    secret.write_text("p w\nsecond line\n")
    args = cli.parser().parse_args(["load", "--root", "r", "--jdbc-url", "jdbc:x:", "--user", "u", "--password-file", str(secret)])
    assert cli._jdbc_props(args) == {"user": "u", "password": "p w"}
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["load", "--root", "r", "--jdbc-url", "jdbc:x:", "--password", "p"])
