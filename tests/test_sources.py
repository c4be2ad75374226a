import csv
import datetime as dt
import pathlib
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from devpulse.constants import NAME_MAPPING, SURVEY_A_HEADERS
from devpulse.plans.spine import mapping_seed, technologies, technology_spine
from devpulse.sources import activity, catalog, files, records, schemas, sinks, wide


def test_scan_csv_keeps_every_row(spark, tmp_path, rows):
    path = tmp_path / "a.csv"
    path.write_bytes(
        b'\xef\xbb\xbfid,first name,note.x\r\n'
        b'1,"a ""quoted"" b","line\none"\r\n'
        b"2,short\r\n"
        b"3,x,y,long\r\n"
        b"4,NA,null\r\n"
    )
    df = files.scan_csv(spark, str(path), multi_line=True)
    assert df.columns == ["id", "first name", "note.x"]
    assert rows(df) == [
        ("1", 'a "quoted" b', "line\none"),
        ("2", "short", None),
        ("3", "x", "y"),
        ("4", None, None),
    ]


def test_scan_csv_with_schema_and_tabs(spark, tmp_path, rows):
    path = tmp_path / "a.tsv"
    path.write_text(
        "activity_month\tlanguage\tn\n2024-01-01\tGo\t5\n2024-02-01\tNone\t6.5\n"
        "soon\tGo\t5\n2024-03-01\tGo\tmany\n2024-04-01\tGo\n"
    )
    schema = StructType.fromDDL("activity_month date, language string, n long")
    df = files.scan_csv(spark, str(path), schema, sep="\t")
    refused = files.scan_csv(spark, str(path), schema, sep="\t", rejected=True)
    assert refused.count() > 0 and all(r.misfits for r in refused.collect())
    # rows that do not fit the types are skipped, short ones are kept
    assert rows(df) == [
        (dt.date(2024, 1, 1), "Go", 5),
        (dt.date(2024, 2, 1), None, 7),
        (dt.date(2024, 4, 1), "Go", None),
    ]


def test_map_columns_first_header_wins(spark, rows):
    df = spark.createDataFrame(
        [(' "7" ', "3", "9", "x", "")],
        ["ResponseId", "YearsCodePro", "WorkExp", "Unknown", "Country"],
    )
    mapped = files.map_columns(df, SURVEY_A_HEADERS, 2025)
    assert mapped.columns == ["survey_year", "response_id", "years_code_pro", "country"]
    assert rows(mapped) == [(2025, "7", "3", None)]


def test_map_columns_reads_dotted_and_quoted_headers(spark, rows):
    df = spark.createDataFrame([("a", "b")], ['"ResponseId"', "OpSysPersonal use"])
    assert rows(files.map_columns(df, SURVEY_A_HEADERS, 2022)) == [(2022, "a", "b")]


def test_years_union_by_name(spark):
    one = files.map_columns(spark.createDataFrame([("1", "US")], ["ResponseId", "Country"]), SURVEY_A_HEADERS, 2021)
    two = files.map_columns(spark.createDataFrame([("2", "x")], ["ResponseId", "AISelect"]), SURVEY_A_HEADERS, 2023)
    raw = schemas.conform(one.unionByName(two, allowMissingColumns=True), schemas.SURVEY_A)
    assert len(raw.columns) == 46 and raw.count() == 2
    assert raw.schema["_loaded_at"].dataType.simpleString() == "timestamp_ntz"


WIDE = {
    "response_id": ["1", "2"],
    "proglang.Go": ["Go", ""],
    "proglang.I don't": ["", "I don't use any"],
    "proglang.Go_103": ["Go", "Go"],
    "primary_proglang.Go": ["Go", None],
    "adopt_proglang.X": ["Not planning to", "  Rust "],
    "os_devenv.Linux": [" ", "Linux"],
    "team_size": ["5", "6"],
}


def wide_frame(spark, columns):
    return spark.createDataFrame(list(zip(*columns.values())), list(columns))


def test_wide_survey_of_2022_drops_meta_answers_and_copies(spark, rows):
    df = wide.load_wide_survey(wide_frame(spark, WIDE), 2022)
    got = rows(
        df, "response_id", "primary_language", "languages_used", "languages_plan_to_adopt",
        "operating_systems", "ides_used", "frameworks_used", "team_size",
    )
    assert got == [
        ("1", "Go", "Go", None, None, None, None, "5"),
        ("2", None, None, "Rust", "Linux", None, None, "6"),
    ]


def test_wide_survey_of_2024_falls_back_and_keeps_order(spark, rows):
    columns = {
        "response_id": ["1", "2"],
        "proglang::B": ["B", None],
        "proglang::A": [" A", "A"],
        "primary_lang::A": ["", "A"],
        "os::Mac": ["Mac", ""],
        "os_dev::Linux": ["Linux", "Linux"],
        "experience": ["1-2", "3-5"],
        "company_coders": ["10", "20"],
    }
    df = wide.load_wide_survey(wide_frame(spark, columns), 2024)
    assert rows(
        df, "response_id", "languages_used", "primary_language", "operating_systems",
        "years_of_experience", "team_size",
    ) == [("1", "B;A", None, "Mac", "1-2", "10"), ("2", "A", "A", "Linux", "3-5", "20")]


def test_wide_survey_needs_an_id(spark):
    df = wide_frame(spark, {"proglang::A": ["A"]})
    with pytest.raises(ValueError):
        wide.load_wide_survey(df, 2023)
    assert wide.load_wide_survey(df, 2023, require_id=False).count() == 1


def test_first_present_field_is_about_headers(spark):
    df = wide_frame(spark, {"dev_experience": [None, "1"], "experience": ["3", "4"]})
    picked = df.select(wide.first_present_field(df, ["dev_experience", "experience"]))
    assert [r[0] for r in picked.collect()] == [None, "1"]


def test_thousands_of_options_stay_one_expression(spark):
    columns = {"response_id": ["1"]} | {f"proglang::L{i}": [f"L{i}" if i % 1000 == 0 else ""] for i in range(3000)}
    df = wide_frame(spark, columns)
    text = df.select(wide.collect_wide_multiselect(df, "proglang::")).first()[0]
    assert text == "L0;L1000;L2000"


def event(kind, day, payload, repo, actor):
    return (dt.datetime.fromisoformat(day), kind, payload, (repo,), (actor,))


EVENT_SCHEMA = (
    "created_at timestamp_ntz, type string, payload string, "
    "repo struct<name:string>, actor struct<login:string>"
)


def test_archive_events(spark, rows):
    go = '{"pull_request":{"base":{"repo":{"language":"Go"}}},"commits":[1,2]}'
    df = spark.createDataFrame(
        [
            event("PushEvent", "2024-01-05", '{"commits":[1,2,3]}', "r1", "a"),
            event("PushEvent", "2024-01-06", '{"commits":[]}', "r1", "b"),
            event("PullRequestEvent", "2024-01-07", go, "r2", "a"),
            event("GollumEvent", "2024-01-07", "{}", "r2", "a"),
            event("PushEvent", "2024-02-01", '{"commits":[1]}', "r1", "a"),
        ],
        EVENT_SCHEMA,
    ).withColumn("day", F.to_date("created_at"))
    kept = files.events_between(df, "2024-01-01", "2024-01-31")
    fields = activity.extract_event_fields(kept)
    month = dt.date(2024, 1, 1)
    assert rows(activity.monthly_events(fields, 1)) == [
        (month, "Go", "PullRequestEvent", 1, 1, 1, 0),
        (month, "Unknown", "PushEvent", 2, 2, 1, 3),
    ]
    assert rows(activity.monthly_events(fields, 2), "event_type") == [("PushEvent",)]
    assert rows(activity.monthly_events(fields, 1, approximate=0.05), "unique_actors") == [(1,), (2,)]


def test_scan_events_prunes_day_folders(spark, tmp_path, rows):
    df = spark.createDataFrame(
        [("PushEvent", "2024-01-01"), ("PushEvent", "2024-01-02"), ("Other", "2024-01-02")],
        "type string, day string",
    ).withColumn("day", F.to_date("day"))
    path = str(tmp_path / "events")
    sinks.write_full_refresh(df, path, ["day"])
    scan = files.scan_events(spark, path, "2024-01-02", "2024-01-02")
    assert rows(scan, "type") == [("PushEvent",)]
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "PushedFilters: [In(type" in plan


def test_expand_year_to_months(spark):
    df = spark.createDataFrame(
        [("Go", 2024, 1200, 24, 7, 0, 3.25, 2.0), ("Go", 2025, 1200, 24, 7, 0, 3.25, 2.0)],
        "language string, year int, repos_pushed long, repos_created long, pr_count long, "
        "issue_count long, avg_stars double, avg_forks double",
    )
    out = activity.expand_year_to_months(df).cache()
    assert out.where("year(activity_month) = 2024").count() == 72
    assert out.where("year(activity_month) = 2025").count() == 66
    january = {r.event_type: r for r in out.where("activity_month = '2024-01-01'").collect()}
    push = january["PushEvent"]
    assert (push.event_count, push.unique_actors, push.unique_repos, push.total_commits) == (800, 80, 100, 2400)
    assert january["IssuesEvent"].event_count == 1  # never below one
    assert january["CreateEvent"].unique_repos == 2
    assert january["ForkEvent"].event_count == 1  # int(2.0 * 24 * 0.05) = 2, spread over 12
    assert january["WatchEvent"].event_count == 177  # int(9600 * 0.1 / 0.45) = 2133
    assert push.avg_repo_stars == 3.3 and push.total_additions == 0


def test_sinks(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    base = spark.createDataFrame([(2021, "a"), (2022, "b"), (2023, "c")], "survey_year int, v string")
    sinks.write_full_refresh(base, path, ["survey_year"])
    new = spark.createDataFrame([(2021, "x")], "survey_year int, v string")
    with pytest.raises(ValueError):
        sinks.write_replace_years(base, path, [2021, 2022])
    assert rows(spark.read.parquet(path), "v") == [("a",), ("b",), ("c",)]
    # a listed year without new rows ends up empty
    sinks.write_replace_years(new, path, [2021, 2022])
    assert rows(spark.read.parquet(path), "v") == [("c",), ("x",)]
    log = str(tmp_path / "log")
    sinks.append_results(base, log)
    sinks.append_results(base, log)
    assert spark.read.parquet(log).count() == 6
    sinks.write_full_refresh(base, log)
    assert spark.read.parquet(log).count() == 3


def test_materialize_and_catalog(spark, tmp_path, rows):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS devpulse_t LOCATION '{tmp_path}'")
    df = spark.createDataFrame([(2, "b"), (1, "a")], "id int, name string")
    assert rows(sinks.materialize(df, "devpulse_view")) == [(1, "a"), (2, "b")]
    assert rows(sinks.materialize(df, "devpulse_t.stored", "table")) == [(1, "a"), (2, "b")]
    spark.sql("CREATE OR REPLACE VIEW devpulse_t.v AS SELECT * FROM devpulse_t.stored")
    assert rows(catalog.list_tables(spark, "devpulse_t")) == [("stored",)]
    assert catalog.list_columns(df) == ["id", "name"]
    assert [r.id for r in catalog.sample_table(df, 1, "first_column").collect()] == [1]
    loaded = df.withColumn("_loaded_at", F.col("id"))
    assert [r.id for r in catalog.sample_table(loaded, 1, "loaded").collect()] == [2]
    assert catalog.sample_table(df, 1).count() == 1
    spark.sql("DROP DATABASE devpulse_t CASCADE")
    with pytest.raises(ValueError):
        sinks.materialize(df, "x", "cube")


def test_cut_lineage_reads_what_it_wrote(spark, rows):
    df = spark.range(5).withColumn("v", F.col("id") * 2)
    cut = sinks.cut_lineage(df)
    assert rows(cut) == rows(df)
    assert "Range" not in cut._jdf.queryExecution().executedPlan().toString()


def test_mapping_seed_facts(spark):
    assert len(NAME_MAPPING) == 91
    spine = technology_spine(mapping_seed(spark))
    assert spine.count() == 91 and technologies(spine).count() == 74
    assert spine.select("technology_id").distinct().count() == 74


def test_spine_keeps_first_mapping(spark, rows):
    seed = spark.createDataFrame(
        [("x", "B", "c", "s"), ("x", "A", "c", "s"), ("x", "A", "c", "s"), ("y", "B", "c", "s")],
        mapping_seed(spark).schema,
    )
    assert rows(technology_spine(seed), "source_name", "canonical_name") == [("x", "A"), ("y", "B")]


def files_in(folder):
    return sorted(p.name for p in pathlib.Path(folder.removeprefix("file:")).iterdir() if p.name.startswith("devpulse-"))


def test_scratch_ends_with_its_scope(spark):
    """Files of a scope go at its end, also after an error; a scoped operator leaves its result alone."""
    folder = sinks.scratch_path(spark).rsplit("/", 1)[0]
    before = files_in(folder)

    @sinks.in_scope
    def doubled(df):
        a = sinks.cut_lineage(df)
        return sinks.cut_lineage(a.union(a))

    with sinks.scratch_scope(spark):
        out = doubled(spark.range(3))
        assert out.count() == 6 and len(files_in(folder)) == len(before) + 1
        with pytest.raises(ValueError), sinks.scratch_scope(spark):
            sinks.cut_lineage(spark.range(2))
            raise ValueError
        assert len(files_in(folder)) == len(before) + 1
    assert files_in(folder) == before


def table_of(count, seed):
    """Rows with every kind of cell: line breaks, quotes, separators, and one longer than a split."""
    rng = random.Random(seed)
    cells = ["plain", "", 'a "word"', "two\nlines", "\n\n", ",,", '"', "\r\n end", "naïve 漢字", "  x "]
    rows = [[str(i), rng.choice(cells), "".join(rng.choices(cells, k=3))] for i in range(count)]
    rows[count // 2][2] = "long\n" * 40_000
    return rows


@pytest.mark.parametrize("sent", [200_000, 0])
def test_quoted_line_breaks_in_split_files(spark, tmp_path, rows, monkeypatch, sent):
    """The rows of `multi_line`, from many tasks; also where splits are too many to be sent."""
    monkeypatch.setattr(records, "SENT_SPLITS", sent)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for seed in (1, 2):
        with (tmp_path / f"{seed}.csv").open("w", newline="", encoding="utf-8-sig") as f:
            writer = csv.writer(f, lineterminator="\r\n" if seed == 2 else "\n")
            writer.writerows([["id", "a b", "c.d"], *table_of(4000, seed)])
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        split = files.scan_csv(spark, str(tmp_path), quoted_breaks=True)
        assert records.quoted_rows(spark, str(tmp_path)).rdd.getNumPartitions() > 20
        got = rows(split)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    want = [(i, *[None if c in ("", "NA") else c for c in cells]) for s in (1, 2) for i, *cells in table_of(4000, s)]
    assert split.columns == ["id", "a b", "c.d"]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_replacing_years_is_all_or_nothing(spark, tmp_path, rows, monkeypatch):
    """Stopped before its decision it leaves the old rows; after it, the next call brings the new."""
    path = f"file:{tmp_path}/t"
    old = spark.createDataFrame([(1, 2021), (2, 2022), (3, 2023)], "v int, survey_year int")
    sinks.write_full_refresh(old, path, ["survey_year"])
    new = spark.createDataFrame([(10, 2021), (30, 2023)], "v int, survey_year int")

    def stop(*args):
        raise OSError("stopped")

    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(sinks, "write_note", stop)
        sinks.write_replace_years(new, path, [2021, 2022, 2023])
    assert rows(spark.read.parquet(path)) == [(1, 2021), (2, 2022), (3, 2023)]
    real, calls = sinks.rename, []

    def once(spark, a, b):
        calls.append(a)
        if len(calls) == 3:  # the note, the first year, then the second
            raise OSError("stopped")
        real(spark, a, b)

    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(sinks, "rename", once)
        sinks.write_replace_years(new, path, [2021, 2022, 2023])
    sinks.finish_replacement(spark, path)
    assert rows(spark.read.parquet(path)) == [(10, 2021), (30, 2023)]
    with pytest.raises(ValueError):
        sinks.write_replace_years(new, path, [2021])
    with pytest.raises(ValueError):
        sinks.write_replace_years(spark.createDataFrame([(1, None)], "v int, survey_year int"), path, [2021])
    assert rows(spark.read.parquet(path)) == [(10, 2021), (30, 2023)]


def test_all_years_of_a_survey(spark, tmp_path, rows):
    (tmp_path / "2021.csv").write_text('ResponseId,Country,Nothing\n1,"US\nA",x\n')
    (tmp_path / "2023.csv").write_text('"Country",AISelect,ResponseId\nNA,Yes,2\n')
    paths = {y: str(tmp_path / f"{y}.csv") for y in (2021, 2022, 2023)}
    raw = files.load_survey_years(spark, paths)
    assert raw.columns == schemas.SURVEY_A.names
    got = rows(raw, "survey_year", "response_id", "country", "ai_select")
    assert got == [(2021, "1", "US\nA", None), (2023, "2", None, "Yes")]
    assert files.load_survey_years(spark, {2022: paths[2022]}).count() == 0


def test_results_without_a_run_get_one(spark, tmp_path):
    path = str(tmp_path / "log")
    results = spark.createDataFrame([("a", 1), ("b", 0)], "test_name string, failure_count long")
    first, second = (sinks.append_results(results, path) for _ in range(2))
    found = {r.run_id: r["count"] for r in spark.read.parquet(path).groupBy("run_id").count().collect()}
    assert found == {first: 2, second: 2} and first != second


def test_bucketed_tables_are_joined_without_a_shuffle(spark):
    keys = ["k", "year"]
    df = spark.range(200).selectExpr("id % 50 as k", "int(id % 3) as year", "id")
    with sinks.scratch_scope(spark):
        one, two = (sinks.scratch_table(df.withColumnRenamed("id", c), keys, 4) for c in ("a", "b"))
        joined = one.hint("merge").join(two, keys)
        assert "Exchange" not in joined._jdf.queryExecution().sparkPlan().toString()
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == df.join(df.withColumnRenamed("id", "b"), keys).count()
        names = {t.name for t in spark.catalog.listTables() if t.name.startswith("devpulse_")}
        assert len(names) == 2
    assert not {t.name for t in spark.catalog.listTables()} & names
