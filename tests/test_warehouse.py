"""Builders together: equivalences, edge rows, publishing, copies, replication."""

import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import physical_plan, rows
from pyspark.sql import functions as F

from daybook import operators as ops
from daybook import sinks
from daybook.catalogue import RUN, spans
from daybook.plans import TARGETS, Run, Span, audit_constraints, build_warehouse
from daybook.plans import dimensions as dims
from daybook.plans import facts
from daybook.plans.audit import reconcile_balance, reconcile_warehouse
from daybook.sources import Include, TableSet, bank_tables
from daybook.sinks.buckets import Directory
from daybook.sinks.tables import _laid_out
from daybook.sinks.versions import current_path, latest_commit
from daybook.sinks.warehouse import read_rejected_intervals, read_rejects, read_unparsed_balances
from daybook.streaming import replicate, selected

SPAN = Span(date(2024, 1, 1), date(2024, 1, 3))
SMALL = Run(1, datetime(2024, 2, 1))


def tiny_bank(spark, **replaced):
    """Two institutions, one without company; account 3 is missing, account 2 has no institution."""
    definitions = {
        "company": ("id int, name string", [(1, "Acme")]),
        "institution": ("id int, company_id int", [(10, 1), (11, None)]),
        "role": ("id int, type string", [(1, "MEMBER"), (2, "STAFF")]),
        "sub_role": ("id int, role_id int", [(1, 1), (2, 2)]),
        "member": (
            "id int, sub_role_id int, institution_id int, created_at string, deleted_at string",
            [
                (1, 1, 10, "2020-01-01", None),
                (2, 2, 10, "2020-01-01", None),
                (3, 1, None, "oops", "2021-01-01"),
                (4, 9, 10, None, None),
            ],
        ),
        "account": ("id int, institution_id int", [(1, 10), (2, None)]),
        "ownership_type": ("id int, key string, type string", [(1, "OWNER", "MEMBER"), (2, "FIRM", "ORGANIZATION")]),
        "member_account": (
            "id int, member_id int, account_id int, ownership_type_id int, is_primary boolean, "
            "created_at string, deleted_at string",
            [
                (1, 1, 1, 1, True, None, None),
                (2, 2, 1, 1, False, None, None),
                (3, 3, 1, 1, False, None, None),
                (4, 1, 1, 2, True, None, None),
                (5, 8, 1, 1, True, None, None),
            ],
        ),
        "account_type": ("id int, value string", [(1, "CHECKING")]),
        "loan": (
            "id int, account_id int, account_type_id int, current_balance double, created_at string, deleted_at string",
            [(1, 1, 1, 5.0, None, None), (2, 3, 1, 6.0, None, None), (3, 2, 7, 7.0, None, "2024-01-01")],
        ),
        "subaccount": (
            "id int, account_id int, account_type_id int, amount double, created_at string, deleted_at string",
            [(1, 1, 1, 5.0, None, None)],
        ),
        "loan_txn": (
            "loan_id int, date date, created_at timestamp_ntz, seq int, balance double, status string, deleted_at timestamp_ntz",
            [(n, date(2024, 1, 2), datetime(2024, 1, 2, 9), 1, 10.0 * n, None, None) for n in (1, 2, 3)],
        ),
        "subaccount_txn": (
            "subaccount_id int, date date, created_at timestamp_ntz, seq int, balance double, status string, deleted_at timestamp_ntz",
            [(1, date(2024, 1, 1), datetime(2024, 1, 1, 9), 1, 3.0, None, None)],
        ),
    }
    frames = {name: spark.createDataFrame(data, schema) for name, (schema, data) in definitions.items()}
    return TableSet.from_frames({**frames, **replaced})


@pytest.fixture
def bank(spark):
    return tiny_bank(spark)


def test_member_dimension_keeps_members_by_role(spark, bank):
    result = dims.build_member(bank, SMALL).select("member_id", "company_id", "status", "created_at", "deleted_at")
    assert rows(result) == [
        ("1", "10", "ACTIVE", datetime(2020, 1, 1), None),
        ("3", None, "INACTIVE", None, datetime(2021, 1, 1)),
    ]


def test_company_dimension_keeps_institutions_without_company(spark, bank):
    result = dims.build_company(bank, SMALL).select("company_id", "name", "parent_company_id")
    assert rows(result) == [("10", "Acme", "1"), ("11", None, None)]


def test_bridge_drops_strangers_staff_and_members_without_company(spark, bank):
    everyone = dims.bridge_all_members(bank, SMALL)
    assert rows(everyone.select("member_account_id", "company_id")) == [("1", "10"), ("2", "10"), ("3", None), ("5", None)]
    known = dims.build_bridge(bank, SMALL)
    assert rows(known.select("member_account_id")) == [("1",)]
    assert rows(known) == rows(dims.keep_known_members(everyone, dims.build_member(bank, SMALL)))


def test_bridge_formulations_agree_on_the_data(spark, data):
    tables = bank_tables(spark, data)
    semi = dims.keep_known_members(dims.bridge_all_members(tables, RUN), dims.build_member(tables, RUN))
    assert rows(dims.build_bridge(tables, RUN)) == rows(semi)


def test_subaccounts_keep_rows_whose_lookups_miss(spark, bank):
    result = dims.build_subaccount(bank, SMALL).select(
        "subaccount_id", "account_id", "company_id", "company_name", "default_type", "default_asset_liability", "status"
    )
    assert rows(result) == [
        ("LOAN1", "INT1", "10", "Acme", "CHECKING", "liability", "ACTIVE"),
        ("LOAN2", "INT3", None, None, "CHECKING", "liability", "ACTIVE"),
        ("LOAN3", "INT2", None, None, None, "liability", "INACTIVE"),
        ("SUB1", "INT1", "10", "Acme", "CHECKING", "asset", "ACTIVE"),
    ]


def test_balances_go_on_for_deleted_and_unplaced_holders(spark, bank):
    fact = facts.build_balance(bank, SMALL, SPAN, SPAN)
    assert fact.schema.simpleString() == TARGETS["fact_balance_subaccount"].schema.simpleString()
    balances = {(r.subaccount_id, r.date.day): r.current_balance for r in fact.collect()}
    expected = {"LOAN1": [0, 10, 10], "LOAN2": [0, 20, 20], "LOAN3": [0, 30, 30], "SUB1": [3, 3, 3]}
    assert balances == {(k, i + 1): Decimal(v) for k, values in expected.items() for i, v in enumerate(values)}


def test_all_rows_of_a_run_carry_one_time(spark, bank):
    for df in build_warehouse(spark, bank, SMALL, SPAN, SPAN).values():
        if "first_uploaded" in df.columns:
            assert {(r.first_uploaded, r.last_uploaded) for r in df.collect()} <= {(SMALL.run_ts, None)}


def test_client_is_seeded_once(spark):
    seed = dims.build_client(spark, SMALL)
    assert rows(seed.select("client_id", "name", "period", "config")) == [(1, "client", None, None)]
    renamed = dims.build_client(spark, Run(1, SMALL.run_ts, "other"))
    assert rows(ops.insert_if_absent(seed, renamed, "client_id")) == rows(seed)


def test_calendar_centres_on_a_day(spark):
    result = dims.build_calendar(spark, date(2024, 2, 29))
    assert result.schema.simpleString() == TARGETS["dim_calendar"].schema.simpleString()
    assert result.count() == 1462


def test_transactions_fact_is_empty_and_typed(spark):
    empty = facts.empty_transactions(spark)
    assert empty.count() == 0 and empty.schema == TARGETS["fact_transactions"].schema


def test_targets_refer_to_earlier_targets_keys():
    seen = []
    for target in TARGETS.values():
        seen.append(target.name)
        assert set(target.key) | set(target.required) | set(target.unique) <= set(target.columns)
        for ref in target.references:
            assert ref.parent in seen and set(ref.parent_columns) == set(TARGETS[ref.parent].key)
            assert set(ref.columns) <= set(target.columns)


def test_constraint_audit_finds_the_planted_gaps(spark, bank):
    built = build_warehouse(spark, bank, SMALL, SPAN, SPAN)
    broken = {(r.target, r.kind, r["columns"]): r.broken for r in audit_constraints(built).collect() if r.broken}
    key = "subaccount_id,account_id,client_id,company_id"
    assert broken == {
        ("dim_member", "not_null", "company_id"): 1,
        ("dim_member", "primary_key", "member_id,client_id,company_id"): 1,
        ("dim_account", "not_null", "company_id"): 1,
        ("dim_account", "primary_key", "account_id,company_id,client_id"): 1,
        ("dim_subaccount", "not_null", "company_id"): 2,
        ("dim_subaccount", "primary_key", key): 2,
        ("fact_balance_subaccount", "not_null", "company_id"): 6,
        ("fact_balance_subaccount", "primary_key", key + ",date"): 6,
    }


def test_repeated_days_are_found_on_any_day(spark, bank):
    fact = facts.build_balance(bank, SMALL, SPAN, SPAN).filter("company_id is not null")
    middle = fact.filter("date = '2024-01-02'")
    broken = audit_constraints({**build_warehouse(spark, bank, SMALL, SPAN, SPAN), "fact_balance_subaccount": fact.union(middle)})
    found = broken.filter("target like 'fact_b%' and kind = 'primary_key'").first()
    assert found.broken == middle.count() == 2


# --- publishing ----------------------------------------------------------------------------------


def test_warehouse_is_published_after_its_audit(spark, bank, tmp_path):
    root = str(tmp_path / "warehouse")
    sinks.load_warehouse(spark, bank, SMALL, SPAN, SPAN, root, "v1", schemas=None)
    published = sinks.read_warehouse(spark, root)
    assert list(published) == list(TARGETS)
    fact = published["fact_balance_subaccount"]
    built = facts.build_balance(bank, SMALL, SPAN, SPAN).filter("company_id is not null")
    assert rows(fact) == rows(built)
    assert rows(published["bridge_member_account"]) == rows(dims.build_bridge(bank, SMALL))
    staging = current_path(spark, root)
    assert rows(read_rejects(spark, staging, "dim_subaccount").select("subaccount_id", "missing")) == [
        ("LOAN2", "company_id"),
        ("LOAN3", "company_id"),
    ]
    assert {r.subaccount_id for r in read_rejected_intervals(spark, staging).collect()} == {"LOAN2", "LOAN3"}


def test_broken_constraints_publish_nothing(spark, bank, tmp_path):
    root = str(tmp_path / "warehouse")
    twice = tiny_bank(spark, loan=bank["loan"].union(bank["loan"]))
    with pytest.raises(sinks.BrokenConstraints, match="fact_balance_subaccount primary_key.* 3"):
        sinks.load_warehouse(spark, twice, SMALL, SPAN, SPAN, root, "v1", schemas=None)
    assert sinks.current_version(spark, root) is None


def test_balances_that_are_no_amounts_are_kept_apart(spark, bank, tmp_path):
    root = str(tmp_path / "warehouse")
    odd = bank["loan_txn"].withColumn("balance", F.when(F.col("loan_id") == 1, 1e17).otherwise(F.col("balance")))
    sinks.load_warehouse(spark, tiny_bank(spark, loan_txn=odd), SMALL, SPAN, SPAN, root, "v1", schemas=None)
    found = read_unparsed_balances(spark, current_path(spark, root))
    assert rows(found) == [("loan_txn", "1", date(2024, 1, 2), "1.0E17")]


def test_sources_with_other_schemas_are_not_loaded(spark, bank, tmp_path):
    with pytest.raises(ValueError, match="source"):
        sinks.load_warehouse(spark, bank, SMALL, SPAN, SPAN, str(tmp_path / "w"), "v1")


def test_reconcile_reports_a_broken_builder(spark, bank, monkeypatch):
    def differences():
        fact = reconcile_balance(bank, SMALL, SPAN, SPAN)
        dims_ = reconcile_warehouse(bank, build_warehouse(spark, bank, SMALL, SPAN, SPAN), SMALL).filter("dataset = 'subaccount'")
        return {(r.metric, r.column_name): r.n for df in (fact, dims_) for r in df.collect() if r.n and r.metric != "compared"}

    assert differences() == {}
    monkeypatch.setattr(facts, "placed_accounts", lambda tables: tables["account"].selectExpr("id + 1 as account_id", "institution_id"))
    monkeypatch.setattr(dims, "named_institutions", lambda tables: tables["institution"].selectExpr("id as institution_id", "company_id as parent_company_id", "'x' as company_name"))
    found = differences()
    assert found[("missing", None)] > 0 and found[("mismatch", "company_name")] > 0


def test_days_are_in_order_though_a_holder_has_two_accounts(spark, bank):
    two = bank["loan"].union(bank["loan"].withColumn("account_id", F.lit(2)))
    fact = facts.build_ordered_balance(tiny_bank(spark, loan=two), SMALL, SPAN, SPAN)
    keys = [(r.subaccount_id, r.date) for r in fact.collect()]
    assert keys == sorted(keys) and len(keys) == 6 * 3 + 3


def test_a_failed_or_repeated_load_leaves_readers_where_they_are(spark, bank, tmp_path):
    root = str(tmp_path / "warehouse")
    sinks.load_warehouse(spark, bank, SMALL, SPAN, SPAN, root, "v1", schemas=None)
    before = rows(sinks.read_warehouse(spark, root)["fact_balance_subaccount"])
    twice = tiny_bank(spark, loan=bank["loan"].union(bank["loan"]))
    with pytest.raises(sinks.BrokenConstraints):
        sinks.load_warehouse(spark, twice, SMALL, SPAN, SPAN, root, "v2", schemas=None)
    with pytest.raises(sinks.VersionExists):
        sinks.load_warehouse(spark, twice, SMALL, SPAN, SPAN, root, "v1", schemas=None)
    assert rows(sinks.read_warehouse(spark, root)["fact_balance_subaccount"]) == before
    sinks.load_warehouse(spark, bank, SMALL, SPAN, SPAN, root, "v2", schemas=None)
    assert sinks.current_version(spark, root) == "v2"


def test_published_fact_equals_the_query_on_the_data(spark, data, tmp_path):
    tables = bank_tables(spark, data)
    root = str(tmp_path / "warehouse")
    sinks.load_warehouse(spark, tables, RUN, *spans(tables), root, "v1")
    published = sinks.read_warehouse(spark, root)["fact_balance_subaccount"]
    built = facts.build_balance(tables, RUN, *spans(tables)).filter("company_id is not null")
    assert published.count() == built.count() and published.exceptAll(built).isEmpty()


@pytest.fixture(scope="module")
def laid_out(spark, data, tmp_path_factory):
    tables, root = bank_tables(spark, data), str(tmp_path_factory.mktemp("laid_out") / "warehouse")
    sinks.load_warehouse(spark, tables, RUN, *spans(tables), root, "v1")
    spark.sql("CREATE DATABASE IF NOT EXISTS laid_out")
    yield root, sinks.publish_tables(spark, root, RUN, "laid_out", 6)
    spark.sql("DROP DATABASE laid_out CASCADE")


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_laid_out_tables_are_joined_without_an_exchange(spark, laid_out, no_broadcast):
    root, written = laid_out
    plain = sinks.read_warehouse(spark, root) | sinks.read_summaries(spark, root)
    for name in written:
        published = spark.table(f"laid_out.{name}")
        assert published.columns == plain[name].columns
        assert published.exceptAll(plain[name]).isEmpty() and plain[name].exceptAll(published).isEmpty()
    for left, right, by in [
        ("fact_balance_subaccount", "dim_subaccount", "subaccount_id"),
        ("bridge_member_account", "dim_account", "account_id"),
        ("fact_balance_account", "dim_account", "account_id"),
        ("fact_balance_member", "dim_member", "member_id"),
    ]:
        joined = spark.table(f"laid_out.{left}").select(by).join(spark.table(f"laid_out.{right}").select(by), by, "left")
        assert "Join" in physical_plan(joined) and "Exchange" not in physical_plan(joined)
        assert "Exchange" in physical_plan(plain[left].select(by).join(plain[right].select(by), by, "left"))
        assert joined.count() == plain[left].select(by).join(plain[right].select(by), by, "left").count()


def test_days_are_spelled_out_in_their_bucket(spark, laid_out):
    root, _ = laid_out
    for name, df in _laid_out(spark, current_path(spark, root), RUN, 6):
        if name.startswith("fact"):
            above = physical_plan(df).split("Generate")[0]
            assert "Generate" in physical_plan(df) and "Exchange" not in above


def test_a_second_layout_takes_over_the_views(spark, laid_out):
    root, written = laid_out
    again = sinks.publish_tables(spark, root, RUN, "laid_out", 3)
    assert set(again) == set(written) and not set(again.values()) & set(written.values())
    assert all(spark.table(table).count() == spark.table(f"laid_out.{name}").count() for name, table in written.items())


# --- copies --------------------------------------------------------------------------------------


def test_copies_are_created_then_merged_and_failures_stay_apart(spark, tmp_path):
    lake = str(tmp_path / "lake")
    good = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "id int, v string")
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "id int, v string")
    with pytest.raises(sinks.CopiesFailed, match="several source rows") as failed:
        sinks.copy_tables(spark, {"twice": twice, "good": good}, lake, "v1")
    assert [r[:2] for r in failed.value.report] == [("twice", "failed"), ("good", "created")]
    change = spark.createDataFrame([(2, None), (3, "c"), (3, "b")], "id int, v string")
    report = sinks.copy_tables(spark, {"good": change}, lake, "v2", orders={"good": ["v"]})
    assert [(r.action, r.error) for r in report.collect()] == [("merged", None)]
    assert rows(sinks.read_copy(spark, f"{lake}/good")) == [(1, "a"), (2, None), (3, "c")]
    assert rows(sinks.read_rejected(spark, f"{lake}/good")) == [(None, "n")]


def test_a_used_label_is_refused_instead_of_losing_rows(spark, tmp_path):
    root = str(tmp_path / "t")
    sinks.upsert_copy(spark, spark.createDataFrame([(1, "a")], "id int, v string"), root, "v1")
    with pytest.raises(sinks.VersionExists):
        sinks.upsert_copy(spark, spark.createDataFrame([(2, "b")], "id int, v string"), root, "v1")
    assert rows(sinks.read_copy(spark, root)) == [(1, "a")]


def bucket_files(spark, root):
    """Files of each bucket of the copy, as its latest commit names them."""
    found = {}
    for f in sinks.read_copy(spark, root).inputFiles():
        found.setdefault(int(f.split("__bucket=")[1].split("/")[0]), set()).add(f)
    return found


def sizes(spark, root):
    return {int(b): size for b, size in json.loads(latest_commit(spark, root).layout)["sizes"].items()}


def test_buckets_cover_every_hash_once(spark):
    directory = Directory.of_bytes(1000, 300)
    assert sorted(directory.sizes) == [4, 5, 6, 7]
    split = directory.split({5: 301, 6: 300, 7: 2000}, 300)
    assert sorted(split.sizes) == [4, 6, 9, 13] + [b for b in range(32, 64) if b % 4 == 3]
    assert split.below(7) == [b for b in range(32, 64) if b % 4 == 3] and split.below(4) == [4]
    keys = spark.range(2000).select("id", directory.bucket("id").alias("old"), split.bucket("id").alias("new"))
    for r in keys.collect():
        assert r.new in split.below(r.old)
    assert {r.new for r in keys.collect()} == set(split.sizes)


def test_first_load_makes_as_many_buckets_as_its_bytes_need(spark, tmp_path):
    rows_ = spark.range(5000).selectExpr("id", "sha2(cast(id as string), 256) as v")
    small, large = (str(tmp_path / name) for name in ("small", "large"))
    sinks.upsert_copy(spark, rows_, small, "v1", bucket_bytes=64 << 10)
    sinks.upsert_copy(spark, rows_, large, "v1")
    assert len(bucket_files(spark, large)) == 1 and len(bucket_files(spark, small)) >= 4
    assert all(len(files) == 1 for files in bucket_files(spark, small).values())
    assert max(sizes(spark, small).values()) < 2 * (64 << 10) and sum(sizes(spark, small).values()) > 100_000
    assert rows(sinks.read_copy(spark, small)) == rows(sinks.read_copy(spark, large)) == rows(rows_)


def test_updates_write_only_the_buckets_they_touch(spark, tmp_path):
    root = str(tmp_path / "t")
    old = spark.range(5000).selectExpr("id", "sha2(cast(id as string), 256) as v")
    sinks.upsert_copy(spark, old, root, "v1", bucket_bytes=64 << 10)
    before = bucket_files(spark, root)
    sinks.upsert_copy(
        spark, spark.createDataFrame([(5, "new"), (10_000, "new")], "id long, v string"), root, "v2", bucket_bytes=1 << 20
    )
    after = bucket_files(spark, root)
    assert set(after) == set(before) and 1 <= sum(after[b] != before[b] for b in before) <= 2
    copy = sinks.read_copy(spark, root)
    assert copy.count() == 5001 and rows(copy.filter("v = 'new'")) == [(10_000, "new"), (5, "new")]


def test_only_the_bucket_that_outgrows_its_target_splits(spark, tmp_path):
    root, target = str(tmp_path / "t"), 96 << 10
    sinks.upsert_copy(spark, spark.range(5000).selectExpr("id", "sha2(cast(id as string), 256) as v"), root, "v1", bucket_bytes=target)
    before, known = bucket_files(spark, root), Directory(sizes(spark, root))
    full = min(before)
    more = spark.range(5000, 60_000).selectExpr("id", "sha2(cast(id as string), 256) as v").filter(known.bucket("id") == full)
    added = more.count()
    sinks.upsert_copy(spark, more, root, "v2", bucket_bytes=target)
    after = bucket_files(spark, root)
    new = set(after) - set(before)
    assert set(before) - set(after) == {full} and len(new) >= 2
    assert all(after[b] == before[b] for b in before if b != full)
    assert all(b % (1 << full.bit_length() - 1) == full - (1 << full.bit_length() - 1) for b in new)
    assert max(sizes(spark, root)[b] for b in new) < 2 * target
    copy = sinks.read_copy(spark, root)
    assert copy.count() == 5000 + added == copy.select("id").distinct().count()
    # The children take later changes like any other bucket.
    sinks.upsert_copy(spark, more.selectExpr("id", "'x' as v"), root, "v3", bucket_bytes=target)
    assert sinks.read_copy(spark, root).filter("v = 'x'").count() == added


def test_a_batch_is_evaluated_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    for version, ids in (("v1", 40), ("v2", 60)):
        batch = spark.range(ids).selectExpr("nullif(id, 3) as id", "id as v").mapInArrow(counted, "id long, v long")
        sinks.upsert_copy(spark, batch, str(tmp_path / "t"), version, order=["v"])
    assert seen.value == 100 and sinks.read_copy(spark, str(tmp_path / "t")).count() == 59
    assert rows(sinks.read_rejected(spark, str(tmp_path / "t"))) == [(None, 3), (None, 3)]


def test_batches_of_no_rows_or_only_rejects_change_nothing(spark, tmp_path):
    root, schema = str(tmp_path / "t"), "id int, v string"
    sinks.upsert_copy(spark, spark.createDataFrame([], schema), root, "v1")
    assert rows(sinks.read_copy(spark, root)) == []
    sinks.upsert_copy(spark, spark.createDataFrame([(1, "a")], schema), root, "v2")
    sinks.upsert_copy(spark, spark.createDataFrame([(None, "n")], schema), root, "v3")
    sinks.upsert_copy(spark, spark.createDataFrame([], schema), root, "v4")
    assert rows(sinks.read_copy(spark, root)) == [(1, "a")] and rows(sinks.read_rejected(spark, root)) == [(None, "n")]


def test_new_columns_fail_or_are_added_and_never_lost(spark, tmp_path):
    root = str(tmp_path / "t")
    sinks.upsert_copy(spark, spark.createDataFrame([(i, "a") for i in range(40)], "id int, v string"), root, "v1", bucket_bytes=256)
    wider = spark.createDataFrame([(1, "b", 7)], "id int, v string, extra int")
    with pytest.raises(ValueError, match="no column extra"):
        sinks.upsert_copy(spark, wider, root, "v2")
    sinks.upsert_copy(spark, wider, root, "v2", new_columns="add")
    copy = sinks.read_copy(spark, root)
    assert copy.columns == ["id", "v", "extra"] and copy.count() == 40
    assert rows(copy.filter("extra is not null")) == [(1, "b", 7)]


def test_uncommitted_versions_stay_unseen(spark, tmp_path):
    root = str(tmp_path / "t")
    attempt = sinks.write_version(spark.range(3), root, "v1")
    assert sinks.current_version(spark, root) is None
    with pytest.raises(FileNotFoundError):
        sinks.current_path(spark, root)
    sinks.commit_version(spark, root, "v1", attempt)
    other = sinks.write_version(spark.range(5), root, "v2")
    assert spark.read.parquet(sinks.current_path(spark, root)).count() == 3
    sinks.commit_version(spark, root, "v2", other)
    assert spark.read.parquet(sinks.current_path(spark, root)).count() == 5
    for label in ("v1", "v2"):
        with pytest.raises(sinks.VersionExists):
            sinks.write_version(spark.range(7), root, label)


def test_catalog_tables_are_created_or_merged(spark, monkeypatch):
    from daybook.sinks import lake

    merged = []
    monkeypatch.setattr(lake, "merge_copy", lambda source, table, key: merged.append((table, rows(source))))
    spark.sql("CREATE DATABASE IF NOT EXISTS dispatch")
    frame = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "id int, v string")
    calls = [sinks.copy_to_catalog(spark, {"t": frame}, "dispatch", "parquet", orders={"t": ["v"]}).first().action for _ in range(2)]
    assert calls == ["created", "merged"] and rows(spark.table("dispatch.t")) == [(1, "b")]
    assert merged == [("dispatch.t", [(1, "b")])]


def test_catalog_copy_is_zstd_parquet(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS lake")
    sinks.create_copy(spark.range(10), "lake.numbers", provider="parquet")
    files = spark.table("lake.numbers").inputFiles()
    assert spark.table("lake.numbers").count() == 10 and all("zstd" in f for f in files)


def test_jdbc_append_follows_references(spark, bank, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    calls = []
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, **kwargs: calls.append(kwargs))
    built = build_warehouse(spark, bank, SMALL, SPAN, SPAN)
    shuffled = {name: built[name] for name in sorted(built, reverse=True)}
    order = sinks.append_in_order(shuffled, "jdbc:none", {"user": "u"})
    assert [c["table"] for c in calls] == [f"public.{name}" for name in order]
    assert {c["mode"] for c in calls} == {"append"} and calls[0]["properties"]["numPartitions"] == "16"
    for name in order:
        for ref in TARGETS[name].references:
            assert order.index(ref.parent) < order.index(name)
    calls.clear()
    sinks.append_in_order(shuffled, "jdbc:none", {"user": "u"}, refresh=True)
    emptied, filled = calls[: len(order)], calls[len(order) :]
    assert [c["table"] for c in emptied] == [c["table"] for c in reversed(filled)]
    assert {(c["mode"], c["properties"].get("truncate")) for c in emptied} == {("overwrite", "true")}
    with pytest.raises(ValueError, match="without parents"):
        sinks.append_in_order({"dim_company": built["dim_company"]}, "jdbc:none", {}, refresh=True)
    with pytest.raises(ValueError, match="nowhere"):
        sinks.append_in_order({"nowhere": built["dim_client"]}, "jdbc:none", {})


def test_items_are_put_in_batches_from_the_tasks(spark, bank, tmp_path):
    out = str(tmp_path)

    def connect():
        import uuid

        def put(batch):
            assert len(batch) <= 2
            for item in batch:
                with open(f"{out}/{uuid.uuid4()}.json", "w") as f:
                    json.dump(item, f, default=str)

        return put

    sinks.publish_items(ops.dictionary_items({"role": bank["role"], "sub_role": bank["sub_role"]}), connect, 2)
    items = sorted((json.loads(p.read_text()) for p in tmp_path.glob("*.json")), key=lambda i: i["id"])
    assert items == [
        {"id": "role1", "source_id": "1", "source_table": "role", "type": "MEMBER"},
        {"id": "role2", "source_id": "2", "source_table": "role", "type": "STAFF"},
        {"id": "sub_role1", "source_id": "1", "source_table": "sub_role", "role_id": 1},
        {"id": "sub_role2", "source_id": "2", "source_table": "sub_role", "role_id": 2},
    ]


def test_replication_resumes_where_it_stopped(spark, tmp_path):
    landing, lake, checkpoint = (str(tmp_path / d) for d in ("landing", "lake", "checkpoint"))
    schema = "id int, at int, v string, status string"
    rules = [Include("txn%", ("status",))]

    def land(*changes):
        spark.createDataFrame(changes, schema).coalesce(1).write.mode("append").parquet(f"{landing}/txn")

    def run(table="txn"):
        parsed = spark.createDataFrame([], schema).schema
        query = replicate(spark, table, parsed, landing, lake, checkpoint, rules, order=["at"])
        if query is not None:
            query.awaitTermination()
        return query

    def copy():
        return rows(selected(spark, "txn", lake, rules))

    land((1, 1, "a", None), (1, 2, "b", None), (2, 1, "x", "PENDING"), (4, 1, "p", None))
    run()
    assert copy() == [(1, 2, "b", None), (4, 1, "p", None)]
    label = sinks.current_version(spark, f"{lake}/txn")
    run()
    assert sinks.current_version(spark, f"{lake}/txn") == label and label.endswith("-0")
    # A row that no longer passes the filters leaves what the filters show.
    land((1, 3, "c", None), (3, 1, "n", None), (4, 2, "p", "PENDING"))
    run()
    assert copy() == [(1, 3, "c", None), (3, 1, "n", None)]
    assert run("other") is None
    # A new checkpoint takes everything again under labels of its own, and loses nothing.
    land((5, 1, "new", None))
    checkpoint = str(tmp_path / "another")
    run()
    assert copy() == [(1, 3, "c", None), (3, 1, "n", None), (5, 1, "new", None)]
