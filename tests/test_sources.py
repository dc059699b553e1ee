"""Binding tables, ad-hoc SQL and writing results."""

import dataclasses
import os
import re

import pytest
from compare import difference_between
from tiny import contact, tiny_tables

from edgelens import (
    EdgeCriteria,
    EdgeQuery,
    SkewProfile,
    TableNames,
    TableSet,
    edge_query,
    edge_query_resolutions,
    export_batch,
    run_sql,
    store_skew,
)
from edgelens.operators.layout import store_dimension
from edgelens.operators.ordering import by_body_tbars, ordered
from edgelens.operators.ranking import with_position
from edgelens.operators.skew import HotKeys
from edgelens.operators.storage import shared_folder
from edgelens.plans import batch
from edgelens.sources import export, schema
from edgelens.sources.export import (
    current_run,
    input_digest,
    input_identity,
    plan_text,
    preview,
    read_in_order,
    read_inputs,
    read_provenance,
    read_results,
    runs,
    summarize,
    write_results,
)


def test_missing_columns_are_named(spark):
    bad = spark.createDataFrame([(1, 2)], "label_a long, label_b long")
    with pytest.raises(ValueError, match="eval is missing, point is missing"):
        schema.conform(bad, schema.RSG, "rsg8")


def test_text_in_a_number_column_is_refused(spark):
    with pytest.raises(ValueError, match="body is string"):
        schema.conform(spark.createDataFrame([("1",)], "body string"), schema.SEPARATE, "separate")


def test_decimal_labels_are_cast_once(spark):
    df = spark.createDataFrame([(1, 2, 3)], "sv int, tbar_count long, other long")
    df = df.withColumn("sv", df.sv.cast("decimal(20,0)"))
    assert schema.conform(df, schema.SV_TBARS, "sv_tbars").dtypes == [
        ("sv", "bigint"),
        ("tbar_count", "bigint"),
    ]


def test_repeated_lookup_keys_are_reported(spark, tables):
    tables.check_keys()
    tiny = tiny_tables(spark, [contact(1, 2)])
    twice = TableSet(**{**vars(tiny), "mask": tiny.mask.unionAll(tiny.mask)})
    with pytest.raises(ValueError, match=r"mask \(9\)"):
        twice.check_keys()


def test_adhoc_sql_sees_tables_and_further_frames(spark):
    tables = tiny_tables(spark, [contact(1, 2), contact(3, 4)], isolated=[3])
    text = "SELECT label_a FROM {rsg8} WHERE label_a IN (SELECT sv FROM {isolated})"
    assert [r.label_a for r in run_sql(tables, text).collect()] == [3]
    mine = spark.range(1, 2)
    text = "SELECT r.label_b FROM {rsg8} r JOIN {mine} m ON m.id = r.label_a"
    found = run_sql(tables, text, mine=mine)
    assert [r.label_b for r in found.collect()] == [2]


@pytest.fixture(scope="module")
def result(tables):
    return edge_query(tables, 8).persist()


@pytest.mark.parametrize("format", ["parquet", "csv"])
def test_results_read_back_as_written(spark, result, tmp_path, format):
    folder = str(tmp_path / "out")
    run = write_results(result, folder, format, parameters=EdgeCriteria().as_parameters())
    assert difference_between(read_results(spark, folder, result), result) is None
    assert run == current_run(spark, folder) and run.n_rows == result.count()


def test_existing_results_are_kept_unless_told(spark, result, tmp_path):
    folder = str(tmp_path / "out")
    write_results(result.limit(1), folder)
    with pytest.raises(FileExistsError, match="out"):
        write_results(result, folder)
    assert read_results(spark, folder, result).count() == 1
    write_results(result, folder, overwrite=True)
    assert read_results(spark, folder, result).count() == result.count()
    assert os.listdir(tmp_path) == ["out"]


def test_a_folder_of_something_else_is_refused(spark, result, tmp_path):
    (tmp_path / "notes.txt").write_text("mine")
    with pytest.raises(FileExistsError):
        write_results(result, str(tmp_path))
    assert os.listdir(tmp_path) == ["notes.txt"]


def test_failing_query_leaves_old_results(spark, result, tmp_path):
    folder = str(tmp_path / "out")
    first = write_results(result, folder)
    failing = result.selectExpr("*", "raise_error('stop') AS stop")
    with pytest.raises(Exception, match="stop"):
        write_results(failing, folder, overwrite=True)
    assert read_results(spark, folder, result).count() == result.count()
    assert os.listdir(tmp_path / "out" / "runs") == [os.path.basename(first.path)]


def test_a_crash_before_the_switch_leaves_the_old_run_current(spark, result, tmp_path, monkeypatch):
    folder = str(tmp_path / "out")
    first = write_results(result.limit(3), folder)

    def crash(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(export, "_commit", crash)
    with pytest.raises(KeyboardInterrupt):
        write_results(result, folder, overwrite=True)
    monkeypatch.undo()
    assert current_run(spark, folder) == first
    assert read_results(spark, folder, result).count() == 3
    # a manifest that is cut off does not count either
    (tmp_path / "out" / "manifests" / "0000000002.json").write_text('{"run": "x", "for')
    assert current_run(spark, folder) == first


def test_a_crash_of_the_first_run_does_not_block_the_next(spark, result, tmp_path, monkeypatch):
    folder = str(tmp_path / "out")
    monkeypatch.setattr(export, "_commit", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        write_results(result, folder)
    monkeypatch.undo()
    with pytest.raises(FileNotFoundError):
        read_results(spark, folder, result)
    write_results(result, folder)
    assert read_results(spark, folder, result).count() == result.count()


def test_the_run_before_is_kept_for_its_readers(spark, result, tmp_path):
    folder = str(tmp_path / "out")
    numbers, readers = [], []
    for n in (1, 2, 3, 4):
        numbers.append(write_results(result.limit(n), folder, overwrite=n > 1).number)
        readers.append(read_results(spark, folder, result))
    assert numbers == [1, 2, 3, 4]
    assert [r.number for r in runs(spark, folder)] == [3, 4]
    assert [r.count() for r in readers[2:]] == [3, 4]
    assert len(os.listdir(tmp_path / "out" / "runs")) == 2


def test_of_two_writers_one_is_told(spark, result, tmp_path, monkeypatch):
    folder, real = str(tmp_path / "out"), export._commit

    def second(spark, folder, run):
        real(spark, folder, run)
        real(spark, folder, run)

    monkeypatch.setattr(export, "_commit", second)
    with pytest.raises(Exception, match="exist"):
        write_results(result.limit(1), folder)


def test_provenance_keeps_parameters_and_plan(spark, result, tmp_path):
    folder = str(tmp_path / "out")
    parameters = EdgeCriteria(min_sv_size_both=1e6).as_parameters()
    write_results(result, folder, parameters=parameters)
    record = read_provenance(spark, folder).first()
    assert record.parameters.asDict() == parameters == current_run(spark, folder).parameters
    assert "Physical Plan" in record.plan


def test_inputs_are_told_apart(spark, tables, result, tmp_path):
    folder = str(tmp_path / "out")
    write_results(result, folder, inputs=input_identity(tables, [8]))
    found = {r.table: r for r in read_inputs(spark, folder).collect()}
    assert set(found) == set(tables.named([8]))
    assert found["rsg8"].n_rows == tables.rsg[8].count()
    assert sorted(f.path for f in found["mask"].files) == sorted(tables.mask.inputFiles())
    assert all(f.bytes > 0 and f.modified > 0 for f in found["mask"].files)
    assert input_digest(tables, [8]) == input_digest(tables, [8]) != input_digest(tables, [16])


def test_one_folder_per_resolution(spark, tables, tmp_path):
    df = edge_query_resolutions(tables, EdgeCriteria(edge_type="intra-body"))
    folder = str(tmp_path / "out")
    run = write_results(df, folder, partition_by=["res"])
    assert {d for d in os.listdir(run.results) if "=" in d} == {"res=8", "res=16", "res=32"}
    assert difference_between(read_results(spark, folder, df), df) is None


@pytest.fixture
def many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_an_order_is_read_back_from_the_files(spark, tables, result, tmp_path, many_ranges):
    folder = str(tmp_path / "out")
    df = ordered(result, by_body_tbars())
    run = write_results(df, folder, in_order=True)
    assert len([f for f in os.listdir(run.results) if f.endswith(".parquet")]) > 1
    back = read_in_order(spark, folder, df)
    assert difference_between(back, with_position(result, by_body_tbars())) is None
    text = plan_text(back)
    assert "Sort" not in text and text.count("Exchange") == text.count("BroadcastExchange")


def test_a_preview_reads_the_first_file_only(spark, result, tmp_path, many_ranges):
    folder = str(tmp_path / "out")
    df = ordered(result, by_body_tbars())
    write_results(df, folder, in_order=True)
    first = preview(spark, folder, df)
    assert len(first.inputFiles()) == 1
    assert first.collect() == df.limit(5).collect()
    whole = preview(spark, folder, df, 10_000)
    assert whole.collect() == df.collect() and len(whole.inputFiles()) > 1


def test_an_order_of_nothing(spark, result, tmp_path):
    folder = str(tmp_path / "out")
    df = result.where("sv_a < 0").orderBy("sv_a")
    assert write_results(df, folder, in_order=True).n_rows == 0
    assert preview(spark, folder, df).collect() == read_in_order(spark, folder, df).collect() == []


def test_an_order_is_not_kept_elsewhere(result, tmp_path):
    for more in ({"format": "csv"}, {"partition_by": ["rownum"]}):
        with pytest.raises(ValueError, match="order"):
            write_results(result, str(tmp_path / "out"), in_order=True, **more)


INTRA = EdgeCriteria(edge_type="intra-body")


def test_a_batch_is_taken_up_where_it_failed(spark, tables, tmp_path, monkeypatch):
    folder, asked, real = str(tmp_path), [], batch.edge_query

    def failing(tables, res, *more):
        asked.append(int(res))
        if res == 16 and asked.count(16) == 1:
            return real(tables, res, *more).selectExpr("*", "raise_error('stop') AS stop")
        return real(tables, res, *more)

    monkeypatch.setattr(batch, "edge_query", failing)
    with pytest.raises(Exception, match="stop"):
        export_batch(tables, folder, INTRA)
    assert asked == [32, 16]
    outputs = export_batch(tables, folder, INTRA)
    assert asked == [32, 16, 16, 8]
    assert [o.skipped for o in outputs.values()] == [True, False, False]
    for res, output in outputs.items():
        expected = real(tables, res, INTRA)
        assert output.run.n_rows == expected.count()
        assert difference_between(read_results(spark, output.folder, expected), expected) is None
    assert all(o.skipped for o in export_batch(tables, folder, INTRA).values())
    assert asked == [32, 16, 16, 8]


def test_a_batch_refuses_and_replaces_other_outputs(spark, tables, tmp_path):
    folder = str(tmp_path)
    export_batch(tables, folder, INTRA, [8])
    other = INTRA.replace(min_two_way_score=0.5)
    with pytest.raises(FileExistsError, match="rsg8"):
        export_batch(tables, folder, other, [32, 8])
    assert os.listdir(tmp_path) == ["rsg8"]
    outputs = export_batch(tables, folder, other, [32, 8], overwrite=True)
    assert not any(o.skipped for o in outputs.values())
    moved = dataclasses.replace(tables, mask=tables.objinfo.selectExpr("id AS obj_id", "5 AS max_mask"))
    with pytest.raises(FileExistsError, match="inputs"):
        export_batch(moved, folder, other, [8])


def test_summary_counts_and_shows_the_first_rows(result):
    summary = summarize(result, "sv_a desc, sv_b")
    assert summary.n_rows == 849
    rows = summary.first_rows.collect()
    assert len(rows) == 5 and rows[0].sv_a >= rows[-1].sv_a


@pytest.fixture(scope="module")
def catalog(spark, tables):
    """The tables under names of their own, with a stored dimension and skew profile."""
    names = TableNames("edgelens_seg").replace(
        rsg16_table="contacts_16nm", sv_dimension_table="sv_dimension", skew_table="hot_keys"
    )
    spark.sql("CREATE DATABASE edgelens_seg")
    stored = {
        names.rsg8_table: tables.rsg[8],
        names.rsg16_table: tables.rsg[16],
        names.rsg32_table: tables.rsg[32],
        names.sv_objinfo_table: tables.objinfo,
        names.sv_mask_class_table: tables.mask,
        names.sv_tbar_count_table: tables.sv_tbars,
        names.sv_excl_table: tables.isolated,
        names.agglo_table: tables.agglo,
        names.agglo_body_size_table: tables.body_sizes,
        names.body_tbar_count_table: tables.body_tbars,
        names.sv_mut_excl_table: tables.separate,
    }
    for name, df in stored.items():
        df.write.saveAsTable(f"edgelens_seg.{name}")
    store_dimension(tables, "edgelens_seg.sv_dimension", 4)
    profile = SkewProfile(HotKeys({0: 2, 5: 3}), ends=HotKeys({0: 2}))
    store_skew(spark, profile, "edgelens_seg.hot_keys")
    yield names, profile
    spark.sql("DROP DATABASE edgelens_seg CASCADE")


def test_query_over_catalog_tables(spark, tables, catalog, tmp_path):
    names, _ = catalog
    plain = names.replace(sv_dimension_table="", skew_table="")
    order = "least(sv_tbars_a, sv_tbars_b) desc, body_a, body_b, sv_a, sv_b"
    query = EdgeQuery(plain).set(min_sv_size_both=1e6).sorted_by(order)
    expected = edge_query(tables, 8, query.criteria)
    assert difference_between(query.query(spark), expected) is None
    assert difference_between(EdgeQuery(names, query.criteria).query(spark), expected) is None
    summary = query.query_and_export(spark, str(tmp_path / "out"))
    assert summary.n_rows == expected.count()
    first = summary.first_rows.collect()
    tbars = [min(r.sv_tbars_a, r.sv_tbars_b) for r in first]
    assert tbars == sorted(tbars, reverse=True)
    read = {r.table: r.n_rows for r in read_inputs(spark, str(tmp_path / "out")).collect()}
    assert read["rsg8"] == tables.rsg[8].count() and "rsg16" not in read


def test_named_dimension_and_profile_are_used(spark, catalog, shuffled):
    names, profile = catalog
    query = EdgeQuery(names.replace(skew_table=""))
    text = plan_text(query.query(spark))
    # only the edges are shuffled: the dimension is read in its buckets
    assert re.findall(r"Arguments: hashpartitioning\((\w+)#", text) == ["sv_a", "sv_b"]
    assert text.count("Bucketed: true") == 2
    assert EdgeQuery(names).skew(spark) == profile
    assert "_hot_key" in plan_text(EdgeQuery(names).query(spark))


def test_a_dimension_that_was_not_checked_is_refused(spark, catalog):
    names, _ = catalog
    spark.table("edgelens_seg.sv_dimension").write.saveAsTable("edgelens_seg.unchecked")
    with pytest.raises(ValueError, match="unchecked"):
        EdgeQuery(names.replace(sv_dimension_table="unchecked")).query(spark)


def test_batch_over_catalog_tables(spark, tables, catalog, tmp_path):
    names, _ = catalog
    query = EdgeQuery(names).set(edge_type="intra-body").sorted_by("sv_a, sv_b")
    outputs = query.batch_and_export(spark, str(tmp_path))
    assert list(outputs) == [32, 16, 8]
    for res, output in outputs.items():
        expected = edge_query(tables, res, INTRA)
        assert difference_between(read_results(spark, output.folder, expected), expected) is None
        assert output.run.parameters["rsg16_table"] == "contacts_16nm"
    assert all(o.skipped for o in query.batch_and_export(spark, str(tmp_path)).values())


def test_shared_folder_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark).startswith(root)
    assert shared_folder(spark) != shared_folder(spark)
