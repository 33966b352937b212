"""Operators 3, 4, 5 and 9: against DuckDB on the small tables, against plain Python on edge rows."""

import hashlib
import re
import time
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tabwright.llm import decontaminate as dc
from tabwright.llm import line_dedup as ld
from tabwright.llm import preference_format as pf
from tabwright.llm import secret_scan as ss
from tabwright.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
BLANK = " \t\n\x0b\x0c\r"
SECRET = "Password = 'abcd1234efgh'"
# null ids and texts, blanks, ties, repeated rows, control characters, a very long text
EDGE = [
    (None, None), (None, ""), (1, None), (2, ""), (3, "  \n\t\n"), (4, "one"), (5, "x\nCommon line \ny"),
    (5, "x\nCommon line \ny"), (5, "other text of the same id"), (6, "common LINE"), (7, " common line\n\nz"),
    (8, f"\x01\x02 {SECRET} \x01 AKIA{'A1' * 10} {'0f' * 14} é{'ab' * 15}"),
    (9, "Écrit ÉCRIT écrit\nCOMMON LINE"), (10, "w " * 60_000 + "end\ncommon line"),
    (11, "token=token:abcdefgh token=\"qwertyuiop\" api_key: zzz"), (12, "-----BEGIN RSA PRIVATE KEY-----"),
]


def edge(spark, rows=EDGE):
    """Extra columns with the names that operators use inside."""
    return spark.createDataFrame([(i, t, n, "a", None) for n, (i, t) in enumerate(rows)],
                                 "doc_id long, text string, __k1 int, __row string, line string")


def lower(s):
    return re.sub("[A-Z]", lambda m: m.group().lower(), s)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    rel = con.execute(ORACLES[name])
    cols = [d[0] for d in rel.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(cols)
    assert sorted(map(str, (tuple(r[c] for c in cols) for r in got.collect()))) == sorted(map(str, rel.fetchall()))


# -- line dedup --------------------------------------------------------------------------------
def test_line_dedup_edges(spark):
    docs = edge(spark)
    found = defaultdict(set)
    for i, t in EDGE:
        for line in (t or "").split("\n"):
            found[lower(line.strip(BLANK))].add((i, t))
    expect = []
    for i, t in EDGE:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not lower(x.strip(BLANK)) or len(found[lower(x.strip(BLANK))]) < 3]
        expect.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    got = [(r["doc_id"], r["text"], r["n_lines"], r["n_dropped"])
           for r in ld.dedup_lines(docs, min_docs=3).collect()]
    assert sorted(map(str, got)) == sorted(map(str, expect))
    assert sum(x[3] for x in expect) >= 6
    whole = ld.with_kept_text(docs, min_docs=3)
    assert whole.columns == docs.columns and whole.count() == len(EDGE)
    by_n = {r["__k1"]: r["text"] for r in whole.collect()}
    assert by_n[0] is None and by_n[6] == "x\ny"


def test_line_dedup_hot_line_and_bitmap(spark):
    """A line in every document and many runs in one document."""
    many = "\n".join("hot" if i % 3 else f"own {i}" for i in range(3000))
    docs = spark.createDataFrame([(i, "HOT\nself %d" % i) for i in range(500)] + [(500, many)],
                                 "doc_id long, text string")
    got = {r["doc_id"]: r for r in ld.dedup_lines(docs).collect()}
    assert got[7]["text"] == "self 7" and got[500]["n_dropped"] == 2000
    assert got[500]["text"] == "\n".join(f"own {i}" for i in range(0, 3000, 3))
    assert sum(r["drop"] for r in got[500]["runs"]) == 2000


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert ld.dedup_lines(docs).count() == 0
    assert dc.decontaminate(docs, items).count() == 0
    stored = ss.address(docs, "doc_id", None, "text")
    assert ss.findings(stored, ss.scan_unseen(stored)).count() == 0
    some = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert [r["n_words"] for r in dc.decontaminate(some, items).collect()] == [3]
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert pf.format_pairs(pf.pairs_of(turns, F.col("conv_id"), F.lit(True))).count() == 0


# -- decontamination ---------------------------------------------------------------------------
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_hits(docs, items, n=10):
    windows = defaultdict(set)
    for item, text in items:
        w = WORD.findall(lower(text or ""))
        for s in range(max(len(w) - n + 1, 1) if w else 0):
            windows[tuple(w[s:s + n])].add(str(item))
    out = []
    for i, text in docs:
        w = WORD.findall(lower(text or ""))
        hit, found = set(), set()
        for s in range(len(w)):
            for size in {len(x) for x in windows}:
                x = tuple(w[s:s + size])
                if len(x) == size and x in windows:
                    hit.update(range(s, s + size))
                    found |= windows[x]
        out.append((i, len(w), len(hit), sorted(found)))
    return out


def test_decontaminate_edges(spark):
    long = " ".join(f"w{i}" for i in range(25))
    items = [(1, long), (2, "Short item"), (3, None), (4, ""), (5, "short ITEM"), (None, "nul item here"),
             (6, "the the the the the the the the the the the"), (7, "never seen words")]
    docs = EDGE + [(20, f"say {long.upper()}!"), (21, "a short-item; short item short"), (22, "the " * 40),
                   (23, " ".join(f"w{i}" for i in range(3, 14))), (24, "Nul item here nul item"),
                   (20, f"say {long.upper()}!")]
    d = edge(spark, docs)
    i = spark.createDataFrame(items, "item_id long, text string")
    got = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in dc.decontaminate(d, i).collect()]
    expect = brute_hits(docs, [x for x in items if x[0] is not None])  # an item without an id is no item
    assert sorted(map(str, got)) == sorted(map(str, expect))
    clean = dc.clean_documents(d, i)
    assert clean.columns == d.columns
    assert clean.count() == sum(x[2] == 0 for x in expect)


def test_items_without_an_id_leak_too(spark, tmp_path):
    import corpus_pipeline
    docs = spark.createDataFrame([(1, "well, nul item here it is"), (2, "nothing"), (3, "nul item here and an other one"),
                                  (4, "other one")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "nul item here"), (None, "Here it is"), (5, "other one"), (None, None)],
                                  "item_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    rel = con.execute(ORACLES["op5_decontaminate"])
    cols = [d[0] for d in rel.description]
    got = {r["doc_id"]: r for r in QUERIES["op5_decontaminate"](spark, str(tmp_path)).collect()}
    assert sorted(map(str, (tuple(r[c] for c in cols) for r in got.values()))) == sorted(map(str, rel.fetchall()))
    assert {i: (r["n_hit"], r["n_items"]) for i, r in got.items()} == {1: (5, 1), 2: (0, 0), 3: (5, 2), 4: (2, 1)}
    assert [r["doc_id"] for r in corpus_pipeline.benchmark(spark, docs, str(tmp_path)).collect()] == [2]


def test_proximity_matches(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "alpha beta gamma"), (2, "alpha so beta gamma"),
                                  (3, "alpha " + "x " * 30 + "beta gamma"), (4, "alpha beta")], "doc_id long, text string")
    got = {r["doc_id"] for r in dc.proximity_matches(docs, items, slop=3).collect()}
    assert got == {1, 2}


def test_proximity_without_the_absent_word(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma"), (2, "unseen words alpha"), (3, "delta")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "alpha so gamma"), (2, "alpha gamma"), (3, "alpha " + "x " * 30 + "gamma"),
                                  (4, "delta"), (None, None)], "doc_id long, text string")
    got = {r["doc_id"]: (r["items"], r["n_items"]) for r in dc.near_items(docs, items, slop=3).collect()}
    assert got == {1: (["1"], 1), 2: (["1"], 1), 3: ([], 0), 4: (["3"], 1), None: ([], 0)}
    assert {r["doc_id"] for r in dc.proximity_matches(docs, items, slop=3).collect()} == {1, 2, 4}


def test_proximity_query_holds_the_exact_matches(spark):
    exact = {r["doc_id"] for r in QUERIES["op5_decontaminate"](spark, SF).collect() if r["contaminated"]}
    near = QUERIES["op5_proximity"](spark, SF).collect()
    assert exact and exact <= {r["doc_id"] for r in near if r["n_near_items"] > 0}
    assert len(near) == spark.read.parquet(f"{SF}/documents.parquet").count()


# -- secrets -----------------------------------------------------------------------------------
def brute_spans(text):
    text = text or ""
    out = []
    for k, r in enumerate(ss.RULES):
        for m in re.finditer(r.pattern, text):
            if len(m.group(r.group)) >= r.min_chars:
                out.append((m.start(), k, m.end(), r.kind))
    return ",".join(f"{kind}:{s}:{e}" for s, _, e, kind in sorted(out))


def test_secret_spans_edges(spark):
    extra = [(30, "https://joe:s3cret@host/x ghp_" + "a1" * 20), (31, "xoxb-123456789012 eyJhbGciOiJI.eyJzdWIiOiI.abcdefghijk"),
             (32, "😀" * 5 + SECRET), (33, "AKIA" + "B" * 10), (34, SECRET)]
    docs = edge(spark, EDGE + extra)
    stored = ss.address(docs, "doc_id", None, "text")
    got = [(r["path"], r["s"]) for r in ss.findings(stored, ss.scan_unseen(stored))
           .withColumn("s", ss.span_text(F.col("spans"))).collect()]
    expect = [(i, brute_spans(t)) for i, t in EDGE + extra]
    assert sorted(map(str, got)) == sorted(map(str, expect))
    assert dict(got)[11] == "assign:21:38" and dict(got)[34]  # the match at 0 took "token" with it


def test_long_logins_and_whole_keys(spark, tmp_path):
    body = "\n".join("Ab3/" * 16 for _ in range(300))
    head, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    rows = [(1, f"see https://user:{'p' * 65}@host and ftp://{'u' * 200}:abc@host"),
            (2, f"x {head}\nProc-Type: 4,ENCRYPTED\n\n{body}\n{end} y {head}\n{body}\n{end}"),
            (3, f"{head}\n{body}\n\n(no end)"), (4, f"{head} is only named"), (5, f"{head}\nAb3=\n{end}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    rel = con.execute(ORACLES["op9_secret_scan"])
    cols = [d[0] for d in rel.description]
    got = {r["doc_id"]: r for r in QUERIES["op9_secret_scan"](spark, str(tmp_path)).collect()}
    assert sorted(map(str, (tuple(r[c] for c in cols) for r in got.values()))) == sorted(map(str, rel.fetchall()))
    spans = {i: [s.split(":") for s in r["spans"].split(",")] for i, r in got.items()}
    texts = {i: [(k, t[int(a):int(b)]) for k, a, b in spans[i]] for i, t in rows}
    assert [k for k, _ in texts[1]] == ["url_login"] * 2 and texts[1][0][1] == f"https://user:{'p' * 65}@"
    keys = [x for k, x in texts[2] if k == "private_key"]
    assert keys == [f"{head}\nProc-Type: 4,ENCRYPTED\n\n{body}\n{end}", f"{head}\n{body}\n{end}"]
    assert [x.rstrip() for k, x in texts[3] if k == "private_key"] == [f"{head}\n{body}"]
    assert texts[4] == [("private_key", head)] and texts[5] == [("private_key", rows[4][1])]


@pytest.mark.parametrize("text, n", [
    ("0123456789abcdef01234567 " * 40_000, 40_000), ("-----BEGIN RSA PRIVATE KEY----- lorem ipsum dolor\n" * 20_000, 20_000),
    ("-----BEGIN " + "AB " * 100_000, 0), ("TOKEN WORDS " * 50_000, 0),
    ("-----BEGIN EC PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\n\n" + "A" * 300_000 + "\n-----END EC PRIVATE KEY-----", 1)],
    ids=["many matches", "many marks", "capitals after a mark", "capitals", "long key"])
def test_spans_of_very_long_texts(spark, text, n):
    stored = ss.address(spark.createDataFrame([(1, text)], "path long, text string"), "path", None, "text")
    begun = time.perf_counter()
    (row,) = ss.findings(stored, ss.scan_unseen(stored)).select(ss.span_text(F.col("spans")).alias("s"), F.size("spans").alias("n")).collect()
    assert row["n"] == n and row["s"] == brute_spans(text)
    assert time.perf_counter() - begun < 20


def test_chunked_spans_equal_brute_force(spark):
    """Numbers of parts around the chunk's size."""
    rows = [(k, "é" + "; ".join(f"token={'x' * (3 + i % 7)}" for i in range(k)) + " end") for k in (0, 1, 31, 32, 33, 63, 64, 65, 200)]
    stored = ss.address(spark.createDataFrame(rows, "path long, text string"), "path", None, "text")
    got = ss.findings(stored, ss.scan_unseen(stored)).select("path", ss.span_text(F.col("spans"))).collect()
    assert sorted(map(tuple, got)) == sorted((k, brute_spans(t)) for k, t in rows)


def test_ledger_scans_only_unseen_pairs(spark):
    v1 = spark.createDataFrame([("a", 1, SECRET), ("b", 1, SECRET), ("c", 1, "clean")], "path string, version int, text string")
    v2 = spark.createDataFrame([("a", 2, "clean"), ("d", 1, SECRET), ("e", 1, "AKIA" + "C" * 20), ("f", 1, None)],
                               "path string, version int, text string")
    stored1 = ss.address(v1, "path", "version", "text")
    ledger = ss.scan_unseen(stored1).cache()
    assert ledger.count() == 2 * len(ss.RULES)
    both = stored1.unionByName(ss.address(v2, "path", "version", "text"))
    new = ss.scan_unseen(both, ledger=ledger)
    blob = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert {r["blob"] for r in new.collect()} == {blob("AKIA" + "C" * 20), blob("")}
    # a newer rule version is run on every blob, the others are not run again
    rules = (ss.Rule("assign", ss.RULES[0].pattern, 2, 6, version=2), *ss.RULES[1:])
    again = ss.scan_unseen(both, rules, ledger.unionByName(new))
    assert {(r["rule"], r["version"]) for r in again.collect()} == {("assign", 2)}
    assert again.count() == 4
    full = ss.findings(both, ledger.unionByName(new))
    hits = {(r["path"], r["version"]): len(r["spans"]) for r in full.collect()}
    assert hits == {("a", 1): 1, ("b", 1): 1, ("c", 1): 0, ("a", 2): 0, ("d", 1): 1, ("e", 1): 1, ("f", 1): 0}


# -- preference pairs --------------------------------------------------------------------------
def test_preference_pairs(spark):
    rows = [
        # pair, side, turn, role, text
        (1, True, 0, "system", "s"), (1, True, 1, "user", "q"), (1, True, 2, "assistant", "good"),
        (1, False, 0, "system", "s"), (1, False, 1, "user", "q"), (1, False, 2, "assistant", "bad"),
        (2, True, 0, "user", "q"), (2, False, 0, "user", "q"),                                   # equal: no completion left
        (3, True, 0, "user", None), (3, True, 1, None, "x"), (3, False, 0, "user", ""), (3, False, 1, "assistant", "y"),
        (4, True, 0, "user", "alone"),
        (5, True, 0, "user", "q"), (5, True, 1, "assistant", "a"), (5, True, 2, "user", "more"),
        (5, False, 0, "user", "q"), (5, False, 1, "assistant", "a"),                              # a prefix of the other
        (None, True, 0, "user", "lost"),
    ]
    t = spark.createDataFrame(rows, "pair long, side boolean, turn long, role string, text string")
    got = {r["pair_id"]: r for r in pf.format_pairs(pf.pairs_of(t, F.col("pair"), F.col("side"))).collect()}
    assert set(got) == {1, 2, 3, 4, 5}
    one = got[1]
    assert one["n_prefix"] == 2 and one["prompt"] == "<|system|>\ns<|end|>\n<|user|>\nq<|end|>\n"
    assert one["chosen"] == "<|assistant|>\ngood<|end|>\n" and one["rejected"] == "<|assistant|>\nbad<|end|>\n"
    span = one["chosen_loss"][0]
    assert one["chosen"][span["start"]:span["end"]] == "good<|end|>\n"
    assert got[2]["n_prefix"] == 0 and got[2]["complete"]
    assert got[3]["n_prefix"] == 1 and got[3]["chosen"].startswith("<|unknown|>") and got[3]["chosen_loss"] == []
    assert got[4]["rejected"] == "" and not got[4]["complete"]
    assert got[5]["n_prefix"] == 1 and got[5]["rejected"] == "<|assistant|>\na<|end|>\n"
    assert len(got[5]["chosen_loss"]) == 1


def test_next_answer_is_the_rejected_side(spark):
    rows = [(1, 0, "user", "q1"), (1, 1, "assistant", "a1"), (1, 2, "user", "more"), (1, 3, "assistant", "b1"),
            (2, 0, "user", "q2"), (2, 1, "assistant", "a2"), (2, 2, "user", "thanks"),
            (3, 0, "user", "nobody answers"), (4, 0, "assistant", "a4"), (None, 0, "assistant", "lost")]
    t = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["pair_id"]: r for r in pf.format_pairs(pf.pairs_with_next_answer(t)).collect()}
    assert set(got) == {1, 2, 3, 4}
    assert got[1]["n_prefix"] == 3 and got[1]["prompt"].endswith("<|user|>\nmore<|end|>\n") and got[1]["complete"]
    assert got[1]["chosen"] == "<|assistant|>\nb1<|end|>\n" and got[1]["rejected"] == "<|assistant|>\na2<|end|>\n"
    assert not any(got[i]["complete"] or got[i]["rejected"] for i in (2, 3, 4))


def test_shared_prefix_query_has_prompts(spark):
    rows = QUERIES["op4_shared_prefix"](spark, SF).collect()
    n = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id").distinct().count()
    assert len(rows) == n and sum(r["n_prefix"] > 0 and r["prompt"] != "" for r in rows) > n // 2
