import json
import os
import tempfile

from stratum.sources.files import Source, list_landing, scan_arff, scan_csv
from stratum.sources.ingest import ingest_all


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def _landing():
    root = tempfile.mkdtemp(prefix="stratum-landing-")
    _write(f"{root}/claims/a.csv", 'id,name,amount\n1,"Smith, J",10.5\n2,Lee,7\n3,Bad,1,extra\n4,Short\n')
    _write(f"{root}/claims/empty.csv", "")
    _write(f"{root}/claims/header_only.csv", "id,name,amount\n")
    _write(f"{root}/claims/ignore.txt", "not,a,claim\n")
    _write(f"{root}/types/t.csv", "ID;Cost\n7;1,5\n")
    _write(f"{root}/cmpl/c.txt", "FORD\tF150\t2010\tBRAKES FAILED\n")
    return root


SOURCES = [
    Source("raw_claims", "claims", "*.csv", "csv", ",", True, pii=("NAME", "vin")),
    Source("raw_nomatch", "claims", "nothing_*.csv", "csv", ",", True),
    Source("raw_types", "types", "*.csv", "csv", ";", True),
    Source("raw_cmpl", "cmpl", "*.txt", "csv", "\t", False, columns=("make", "model", "year", "text")),
    Source("raw_missing", "nothing_here", "*.csv"),
]


def test_scan_csv_rescues_bad_rows(spark):
    root = _landing()
    df = scan_csv(spark, f"{root}/claims", SOURCES[0])
    rows = {r["id"]: r for r in df.collect()}
    assert set(rows) == {"1", "2", "3", "4"}
    assert rows["1"]["name"] == "Smith, J" and rows["1"]["_rescued_data"] is None
    assert rows["3"]["_rescued_data"] is not None and '"raw":"3,Bad,1,extra"' in rows["3"]["_rescued_data"]
    assert rows["4"]["_rescued_data"] is not None and rows["4"]["amount"] is None
    assert all(isinstance(v, (str, type(None))) for r in rows.values() for v in r)


def test_streaming_ingest_idempotent(spark):
    root = _landing()
    out = tempfile.mkdtemp(prefix="stratum-bronze-")
    st1 = {r["table"]: r["status"] for r in ingest_all(spark, SOURCES, root, f"{out}/b", f"{out}/c").collect()}
    assert st1 == {"raw_claims": "OK", "raw_types": "OK", "raw_cmpl": "OK", "raw_missing": "SKIPPED_no_file",
                   "raw_nomatch": "SKIPPED_no_file"}
    tags = {f.name: (f.metadata or {}).get("tags") for f in spark.read.parquet(f"{out}/b/raw_claims").schema.fields}
    assert tags["name"] == {"pii": "true"} and tags["id"] is None
    spark.catalog.clearCache()
    n1 = {t: spark.read.parquet(f"{out}/b/{t}").count() for t in ("raw_claims", "raw_types", "raw_cmpl")}
    assert n1 == {"raw_claims": 4, "raw_types": 1, "raw_cmpl": 1}
    ingest_all(spark, SOURCES, root, f"{out}/b", f"{out}/c")
    n2 = {t: spark.read.parquet(f"{out}/b/{t}").count() for t in n1}
    assert n2 == n1                                    # re-run adds 0 rows
    cm = spark.read.parquet(f"{out}/b/raw_cmpl").first()
    assert (cm["make"], cm["text"]) == ("FORD", "BRAKES FAILED")
    _write(f"{root}/claims/b.csv", "id,name,amount\n9,New,1\n")
    ingest_all(spark, SOURCES, root, f"{out}/b", f"{out}/c")
    assert spark.read.parquet(f"{out}/b/raw_claims").count() == 5   # only the new file


def test_list_landing(spark):
    root = _landing()
    names = {r["name"] for r in list_landing(spark, root).collect()}
    assert {"a.csv", "t.csv", "c.txt", "ignore.txt"} <= names


def test_arff(spark):
    root = tempfile.mkdtemp(prefix="stratum-arff-")
    _write(f"{root}/sev.arff", "% comment\n@RELATION sev\n@ATTRIBUTE IDpol NUMERIC\n"
                               "@ATTRIBUTE ClaimAmount NUMERIC\n\n@DATA\n1,995.2\n3,1128.12\n")
    df = scan_arff(spark, f"{root}/sev.arff")
    assert df.columns == ["IDpol", "ClaimAmount", "_rescued_data"]
    assert sorted(tuple(r) for r in df.collect()) == [("1", "995.2", None), ("3", "1128.12", None)]


def test_continuous_mode_picks_up_new_files(spark):
    from stratum.sources.ingest import start_ingest
    root = _landing()
    out = tempfile.mkdtemp(prefix="stratum-cont-")
    src = SOURCES[2]                                   # raw_types, ';' separated
    q = start_ingest(spark, src, root, f"{out}/t", f"{out}/ck", "b1", processing_time="1 second")
    try:
        q.processAllAvailable()
        assert spark.read.parquet(f"{out}/t").count() == 1
        _write(f"{root}/types/u.csv", "ID;Cost\n8;2\n9;3\n")
        q.processAllAvailable()
        assert spark.read.parquet(f"{out}/t").count() == 3
    finally:
        q.stop()


def test_files_are_read_by_their_own_header(spark):
    root = tempfile.mkdtemp(prefix="stratum-headers-")
    _write(f"{root}/d/a1.csv", "x,y\n1,2\n")
    _write(f"{root}/d/a2.csv", "y,x\n20,10\n")
    _write(f"{root}/d/a3.csv", "x,y,extra\n5,6,9\n")
    _write(f"{root}/d/a4.csv", "x,renamed\n7,8\n")
    _write(f"{root}/d/a5 %20é.csv", "x\n11\n")
    out = tempfile.mkdtemp(prefix="stratum-bronze-")
    src = Source("raw_d", "d", "*.csv")
    assert ingest_all(spark, [src], root, f"{out}/b", f"{out}/c").first()["status"] == "OK"
    rows = {r.x: r for r in spark.read.parquet(f"{out}/b/raw_d").collect()}
    assert {k: r.y for k, r in rows.items()} == {"1": "2", "10": "20", "5": "6", "7": None, "11": None}
    extra = {k: json.loads(r._rescued_data)["extra"] for k, r in rows.items() if r._rescued_data}
    assert extra == {"5": {"extra": "9"}, "7": {"renamed": "8"}}
    _write(f"{root}/d/b.csv", "z,y,x\n3,2,12\n")             # a later run keeps the table's columns
    ingest_all(spark, [src], root, f"{out}/b", f"{out}/c")
    late = spark.read.parquet(f"{out}/b/raw_d").where("x = '12'").first()
    assert late.y == "2" and json.loads(late._rescued_data)["extra"] == {"z": "3"}


def test_json_fields_are_rescued_and_broken_sources_stay_alone(spark):
    root = tempfile.mkdtemp(prefix="stratum-json-")
    _write(f"{root}/j/a.json", '{"a":1,"b":{"c":2},"extra":9}\n{"a":3}\nnot json\n')
    _write(f"{root}/k/a.json", '{"p":1}\n{"q":"x"}\n')
    _write(f"{root}/h/a.txt", "1\t2\n")
    out = tempfile.mkdtemp(prefix="stratum-bronze-")
    sources = [Source("raw_h", "h", "*.txt", "csv", "\t", False), Source("raw_j", "j", "*.json", "json"),
               Source("raw_odd", "k", "*.json", "xml"), Source("raw_k", "k", "*.json", "json")]
    got = {r.table: r.status for r in
           ingest_all(spark, sources, root, f"{out}/b", f"{out}/c", {"raw_j": ("a", "b")}).collect()}
    assert got["raw_j"] == got["raw_k"] == "OK"
    assert got["raw_h"].startswith("ERROR:") and got["raw_odd"].startswith("ERROR:")
    rows = spark.read.parquet(f"{out}/b/raw_j").collect()
    by = {r.a: r for r in rows}
    assert by["1"].b == '{"c":2}' and json.loads(by["1"]._rescued_data)["extra"] == {"extra": "9"}
    assert by["3"]._rescued_data is None and json.loads(by[None]._rescued_data)["raw"] == "not json"
    assert sorted((r.p, r.q) for r in spark.read.parquet(f"{out}/b/raw_k").collect() if r.p) == [("1", None)]


def test_arff_surplus_tokens_are_rescued(spark):
    root = tempfile.mkdtemp(prefix="stratum-arff-")
    _write(f"{root}/s.arff", "@RELATION s\n@ATTRIBUTE 'the id' NUMERIC\n@ATTRIBUTE b NUMERIC\n@DATA\n1,2\n3,4,5\n6,?\n")
    rows = {r["the id"]: r for r in scan_arff(spark, f"{root}").collect()}
    assert rows["1"]["_rescued_data"] is None and rows["6"]["b"] is None
    assert json.loads(rows["3"]["_rescued_data"])["raw"] == "3,4,5"


def test_feeds_share_no_files():
    from stratum.config import CLAIM_SOURCES, SPECIFIED_SOURCES
    places = [(s.subdir, s.pattern) for s in (*CLAIM_SOURCES, *SPECIFIED_SOURCES)]
    assert len(places) == len(set(places))


def _rows(spark, text, sep=",", name="a.csv", **kw):
    root = tempfile.mkdtemp(prefix="stratum-csv-")
    with open(f"{root}/{name}", "wb") as f:
        f.write(text.encode("utf-8"))
    return scan_csv(spark, root, Source("t", "", "*.csv", "csv", sep, **kw)).collect()


def test_blank_first_lines_and_byte_order_mark(spark):
    for text in ("\nid,v\n1,a\n2,b\n", "\ufeffid,v\n1,a\n2,b\n", "\ufeff\n  \nid,v\n1,a\n\n2,b\n"):
        assert sorted((r.id, r.v, r._rescued_data) for r in _rows(spark, text)) == [("1", "a", None), ("2", "b", None)]


def test_quoted_line_breaks(spark):
    text = ('id,v,w\n1,"a\nb",x\n2,"one line",y\n3,"c ""q""\n\nid,v,w\nd","e\nf"\n4,plain,z\n'
            '5,"x, ""y""",5" pipe\n6,"\r\n",u\n')
    rows = {r.id: r for r in _rows(spark, text)}
    assert {k: (r.v, r.w) for k, r in rows.items()} == {
        "1": ("a\nb", "x"), "2": ("one line", "y"), "3": ('c "q"\n\nid,v,w\nd', "e\nf"), "4": ("plain", "z"),
        "5": ('x, "y"', '5" pipe'), "6": ("\n", "u")}
    assert all(r._rescued_data is None for r in rows.values())


def test_quoted_line_breaks_across_splits(spark):
    import csv
    import io
    import random
    rnd = random.Random(3)
    want, out = [], io.StringIO()
    write = csv.writer(out, lineterminator="\n")
    write.writerow(["id", "v", "w"])
    for i in range(600):
        v = "".join(rnd.choice(["a", "b ", '"', "\n", ",", ";", "\n\n", "é"]) for _ in range(rnd.randint(1, 12)))
        want.append((str(i), f"x{v}x", "end"))
        write.writerow(want[-1])
    for size in (300, 1000, 1 << 20):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
        try:
            got = sorted(((r.id, r.v, r.w) for r in _rows(spark, out.getvalue())), key=lambda r: int(r[0]))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert got == want


def test_stray_quotes_swallow_nothing(spark, monkeypatch):
    rows = _rows(spark, 'id,v\n1,"never closed\n2,b\n3,c\n')
    assert {r.id for r in rows} >= {"2", "3"} and len(rows) == 3
    rows = _rows(spark, 'id,v\n1,5" pipe\n2,b\n3,6" pipe\n')           # no quote begins a field
    assert [(r.id, r.v) for r in sorted(rows)] == [("1", '5" pipe'), ("2", "b"), ("3", '6" pipe')]
    from stratum.sources import files
    monkeypatch.setattr(files, "RECORD_LINES", 3)
    rows = _rows(spark, 'id,v\n1,"a\nb"\n2,"open\n3,c\n4,d\n5,e"\n6,f\n')
    assert {(r.id, r.v) for r in rows} >= {("1", "a\nb"), ("3", "c"), ("4", "d"), ("6", "f")} and len(rows) == 6


def test_headerless_file_with_a_byte_order_mark(spark):
    rows = _rows(spark, "\ufeff1\ta\n2\t\"b\nc\"\n", "\t", header=False, columns=("k", "v"))
    assert sorted((r.k, r.v) for r in rows) == [("1", "a"), ("2", "b\nc")]


def test_evolving_columns(spark):
    from stratum.sources.ingest import log_columns, read_bronze, table_columns
    root, out = tempfile.mkdtemp(prefix="stratum-ev-"), tempfile.mkdtemp(prefix="stratum-evb-")
    src = [Source("t", "t", "*.csv", pii=("n",)), Source("j", "j", "*.json", "json")]

    def run():
        st = ingest_all(spark, src, root, f"{out}/b", f"{out}/c", evolve=True)
        assert {r.status for r in st.collect()} == {"OK"}
    _write(f"{root}/t/a.csv", "x,y\n1,2\n")
    _write(f"{root}/j/a.json", '{"p":1}\n')
    run()
    _write(f"{root}/t/b.csv", "Y,n\n3,4\n")
    _write(f"{root}/j/b.json", '{"q":"z"}\n')
    run()
    _write(f"{root}/t/c.csv", "y,x\n5,6\n")
    run()
    rows = read_bronze(spark, f"{out}/b/t")
    assert table_columns(spark, f"{out}/b/t") == ["x", "y", "n"]
    assert sorted(((r.x, r.y, r.n) for r in rows.collect()), key=str) == \
        sorted([("1", "2", None), (None, "3", "4"), ("6", "5", None)], key=str)
    assert rows.where("_rescued_data IS NOT NULL").count() == 0
    assert sorted(((r.p, r.q) for r in read_bronze(spark, f"{out}/b/j").collect()), key=str) == [("1", None), (None, "z")]
    # a version cut short by a failure counts as none
    with open(f"{out}/b/t/_columns/9", "w") as f:
        f.write('"x"\n"y"')
    assert table_columns(spark, f"{out}/b/t") == ["x", "y", "n"]
    log_columns(spark, f"{out}/b/t", ["x", "y", "n", "m"])
    assert table_columns(spark, f"{out}/b/t") == ["x", "y", "n", "m"]


def test_json_keys_that_are_data_are_refused(spark, monkeypatch):
    import pytest
    from stratum.sources import files
    monkeypatch.setattr(files, "MOST_FIELDS", 3)
    root = tempfile.mkdtemp(prefix="stratum-json-")
    _write(f"{root}/a.json", "\n".join('{"k%d":1}' % i for i in range(5)))
    with pytest.raises(ValueError):
        files.scan_json(spark, root, Source("t", "", "*.json", "json"))
