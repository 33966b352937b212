"""Registered queries of the subpackage: ``QUERIES`` (name -> function) and ``ORACLES`` (SQL)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.llm import cotrain_quality as cq
from tabwright.llm import cover_dedup as cd
from tabwright.llm import decontaminate as dc
from tabwright.llm import line_dedup as ld
from tabwright.llm import merkle_manifest as mm
from tabwright.llm import minhash_dedup as mh
from tabwright.llm import packing as pk
from tabwright.llm import preference_format as pf
from tabwright.llm import repetition as rp
from tabwright.llm import secret_scan as ss
from tabwright.llm import spelling_groups as sg
from tabwright.llm import suffix_dedup as sd
from tabwright.llm import toxicity_mil as tm
from tabwright.llm.common import UPPER, table, written

ASCII_LOWER_SQL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


# -- op1 ---------------------------------------------------------------------------------------
def op1_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its near-duplicate class (its smallest doc_id) and the class's size."""
    c = mh.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
    return c.select("doc_id", "class_id", "class_size")


# -- op2 ---------------------------------------------------------------------------------------
def op2_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pk.pack(table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path())
    return p.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                    "sequence_id", "offset", "sequence_length")


# -- op3 ---------------------------------------------------------------------------------------
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = ld.dedup_lines(table(spark, sf_dir, "documents", "doc_id", "text"))
    return d.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP3_SQL = f"""
WITH l AS (
  SELECT doc_id, i, lines[i] AS line,
         {ASCII_LOWER_SQL.format("trim(lines[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))),
common AS (SELECT key FROM l WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT l.doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE c.key IS NOT NULL) AS n_dropped,
       sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN common c ON c.key = l.key
GROUP BY l.doc_id"""


# -- op4 ---------------------------------------------------------------------------------------
def op4_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations 2p and 2p + 1 are the chosen and the rejected side of pair p."""
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    pairs = pf.pairs_of(turns, F.expr("conv_id div 2"), F.col("conv_id") % 2 == 0)
    return _formatted(pairs)


def op4_shared_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against itself with its last answer taken from the next conversation."""
    return _formatted(pf.pairs_with_next_answer(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")))


def _formatted(pairs: DataFrame) -> DataFrame:
    out = pf.format_pairs(pairs)
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(
        ":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return out.select("pair_id", "n_prefix", "prompt", "chosen", "rejected",
                      spans("chosen_loss").alias("chosen_loss"),
                      spans("rejected_loss").alias("rejected_loss"), "complete")


OP4_SQL = """
WITH t AS (
  SELECT conv_id // 2 AS pair_id, conv_id % 2 = 0 AS side,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i,
         coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT pair_id, count(*) FILTER (WHERE side) AS nc, count(*) FILTER (WHERE NOT side) AS nr FROM t GROUP BY 1),
d AS (SELECT c.pair_id, min(c.i) FILTER (WHERE r.i IS NULL OR c.role <> r.role OR c.text <> r.text) AS first_diff
      FROM (SELECT * FROM t WHERE side) c
      LEFT JOIN (SELECT * FROM t WHERE NOT side) r ON r.pair_id = c.pair_id AND r.i = c.i GROUP BY 1),
p AS (SELECT n.pair_id, nc, nr,
             greatest(least(coalesce(d.first_diff - 1, 1000000000), nc - 1, nr - 1), 0) AS n_prefix
      FROM n LEFT JOIN d ON d.pair_id = n.pair_id),
x AS (SELECT t.pair_id, t.side, t.i, t.role, p.n_prefix, nc, nr,
             '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10) AS s,
             t.i <= p.n_prefix AS in_prompt
      FROM t JOIN p ON p.pair_id = t.pair_id),
y AS (SELECT *, CASE WHEN in_prompt THEN 0 ELSE coalesce(sum(length(s)) FILTER (WHERE NOT in_prompt) OVER (
             PARTITION BY pair_id, side ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) END AS begun
      FROM x)
SELECT pair_id, CAST(n_prefix AS BIGINT) AS n_prefix,
  coalesce(string_agg(s, '' ORDER BY i) FILTER (WHERE side AND in_prompt), '') AS prompt,
  coalesce(string_agg(s, '' ORDER BY i) FILTER (WHERE side AND NOT in_prompt), '') AS chosen,
  coalesce(string_agg(s, '' ORDER BY i) FILTER (WHERE NOT side AND NOT in_prompt), '') AS rejected,
  coalesce(string_agg(CAST(begun + length(role) + 5 AS BIGINT) || ':' || CAST(begun + length(s) AS BIGINT), ',' ORDER BY i)
    FILTER (WHERE side AND NOT in_prompt AND role = 'assistant'), '') AS chosen_loss,
  coalesce(string_agg(CAST(begun + length(role) + 5 AS BIGINT) || ':' || CAST(begun + length(s) AS BIGINT), ',' ORDER BY i)
    FILTER (WHERE NOT side AND NOT in_prompt AND role = 'assistant'), '') AS rejected_loss,
  (max(nc) > 0 AND max(nr) > 0) AS complete
FROM y GROUP BY pair_id, n_prefix"""

OP4_SHARED_SQL = """
WITH c AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) AS i,
         coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
a AS (SELECT conv_id, max(i) AS at FROM c WHERE role = 'assistant' GROUP BY conv_id),
o AS (SELECT c.conv_id - 1 AS conv_id, c.text AS other FROM c JOIN a ON a.conv_id = c.conv_id AND a.at = c.i),
t AS (SELECT conv_id AS pair_id, true AS side, i, role, text FROM c
      UNION ALL
      SELECT c.conv_id, false, c.i, c.role, CASE WHEN c.i = a.at THEN o.other ELSE c.text END
      FROM c JOIN a ON a.conv_id = c.conv_id JOIN o ON o.conv_id = c.conv_id),
""" + OP4_SQL[OP4_SQL.index("n AS (SELECT"):]


# -- op5 ---------------------------------------------------------------------------------------
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = dc.decontaminate(table(spark, sf_dir, "documents", "doc_id", "text"),
                         table(spark, sf_dir, "benchmark", "item_id", "text"), unnamed=True)
    return d.select("doc_id", "n_words", "n_hit", "n_items",
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                    (F.col("n_hit") > 0).alias("contaminated"))


def op5_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark items that it holds nearly: rarest words within five words."""
    d = dc.near_items(table(spark, sf_dir, "documents", "doc_id", "text"),
                      table(spark, sf_dir, "benchmark", "item_id", "text"), unnamed=True)
    return d.select("doc_id", F.col("n_items").alias("n_near_items"), F.array_join("items", ",").alias("near_items"))


OP5_SQL = rf"""
WITH iw AS (SELECT CAST(item_id AS VARCHAR) AS item,
                   regexp_extract_all({ASCII_LOWER_SQL.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark),
win AS (SELECT DISTINCT item, array_to_string(w[s : s + 9], ' ') AS phrase, least(len(w), 10) AS n
        FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM iw WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
dw AS (SELECT doc_id, regexp_extract_all({ASCII_LOWER_SQL.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
       FROM documents),
pos AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS s FROM dw),
hit AS (SELECT pos.doc_id, pos.s, win.n, win.item
        FROM pos JOIN lens ON pos.s + lens.n - 1 <= len(pos.w)
        JOIN win ON win.n = lens.n AND win.phrase = array_to_string(pos.w[pos.s : pos.s + lens.n - 1], ' ')),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(dw.w) AS BIGINT) AS n_words, coalesce(cov.n_hit, 0) AS n_hit,
       coalesce(its.n_items, 0) AS n_items, sha256(coalesce(its.items, '')) AS items_sha256,
       coalesce(cov.n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN cov ON cov.doc_id = dw.doc_id LEFT JOIN its ON its.doc_id = dw.doc_id"""


# -- op6 ---------------------------------------------------------------------------------------
def op6_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = rp.repetition(table(spark, sf_dir, "documents", "doc_id", "text"))
    return r.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept", "line_share", "line_char_share", "top_shares", "dup_shares")


# -- op7 ---------------------------------------------------------------------------------------
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = sd.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return r.select("doc_id", "n_bytes", removed.alias("n_removed"),
                    F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


# -- op8 ---------------------------------------------------------------------------------------
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = tm.fit(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return tm.score(docs, model).select(
        "doc_id", tm.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "offending")


# -- op9 ---------------------------------------------------------------------------------------
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as paths with one version each, scanned from an empty ledger."""
    stored = ss.address(table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", None, "text")
    return _findings(ss.findings(stored, ss.scan_unseen(stored)))


def _findings(found: DataFrame, *more) -> DataFrame:
    base = F.filter("spans", lambda s: s["ord"] < len(ss.BASE_RULES))
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(F.col("path").alias("doc_id"), n("assign").alias("n_assign"),
                        n("access").alias("n_access"), n("hex").alias("n_hex"),
                        F.sha2(ss.span_text(base), 256).alias("base_sha256"),
                        ss.span_text(F.col("spans")).alias("spans"), *more)


NEWER = tuple(replace(r, version=r.version + 1) if r.kind == "jwt" else r for r in ss.RULES)


def op9_rescan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of even id are scanned first and the ledger is stored; then all documents, under a newer version of
    one rule: ``n_scanned`` rule versions had to be run on the document's blob."""
    stored = ss.address(table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", None, "text")
    ledger = written(ss.scan_unseen(stored.where("path % 2 = 0")), "secret-ledger")
    new = written(ss.scan_unseen(stored, NEWER, ledger), "secret-ledger")
    found = ss.findings(stored, ledger.unionByName(new), NEWER)
    n = written(new.groupBy("blob").agg(F.count(F.lit(1)).alias("n_scanned")), "secret-counts")
    return _findings(found.join(n, "blob", "left"), F.coalesce("n_scanned", F.lit(0)).cast("long").alias("n_scanned"))


def _op9_sql() -> str:
    """Each rule's matches bracketed by chr(1), as in the operator, and cut apart by position."""
    parts = []
    for i, r in enumerate(ss.RULES):
        pat = r.pattern.replace("'", "''").replace("*+", "*").replace("++", "+")  # possessive repeats match the same here
        parts.append(f"""
  SELECT doc_id, {i} AS ord, '{r.kind}' AS kind, start, start + length(m) AS stop, g FROM (
    SELECT doc_id, j, string_split(seg, chr(2))[1] AS m, string_split(seg, chr(2))[2] AS g, seg,
           CAST(coalesce(sum(length(string_split(seg, chr(2))[1])) OVER (
             PARTITION BY doc_id ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
    FROM (SELECT doc_id, unnest(range(1, len(segs) + 1)) AS j, unnest(segs) AS seg
          FROM (SELECT doc_id, string_split(regexp_replace(t, '{pat}',
                  chr(1) || '\\0' || chr(2) || '\\{r.group}' || chr(1), 'g'), chr(1)) AS segs FROM d)))
  WHERE j % 2 = 0 AND length(g) >= {r.min_chars}""")
    nb = len(ss.BASE_RULES)
    return f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), chr(1) || chr(2), chr(3) || chr(3)) AS t FROM documents),
s AS ({" UNION ALL ".join(parts)}),
a AS (SELECT doc_id, count(*) FILTER (WHERE ord = 0) AS n_assign, count(*) FILTER (WHERE ord = 1) AS n_access,
             count(*) FILTER (WHERE ord = 2) AS n_hex,
             string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) FILTER (WHERE ord < {nb}) AS base,
             string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) AS spans
      FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a ON a.doc_id = d.doc_id"""


# -- op10 --------------------------------------------------------------------------------------
def op10_cotrain_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = cq.co_train(table(spark, sf_dir, "documents", "doc_id", "text", "source", "lang", "n_chars"),
                    table(spark, sf_dir, "labels", "doc_id", "quality"))
    return c.select("doc_id", "score", "content_score", "meta_score", "kept")


# -- op11 --------------------------------------------------------------------------------------
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof; where 5 divides crc32 of its id, the root is folded from its lower-cased text."""
    docs = table(spark, sf_dir, "documents", *LEAF_COLUMNS)
    changed = mm.leaf_of(*[F.translate(c, UPPER, UPPER.lower()) if c == "text" else F.col(c) for c in LEAF_COLUMNS])
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.unhex(changed))
    m = mm.build(docs, LEAF_COLUMNS, carry={"tampered": tampered})
    p = mm.prove(m, m.leaves, "id", "tampered")
    folded = mm.fold(mm.hex_text(F.coalesce("tampered", "leaf")), F.col("path"))
    return p.select(F.col("id").alias("doc_id"), mm.hex_text(F.col("leaf")).alias("leaf"),
                    mm.hex_text(F.col("subroot")).alias("subroot"), F.lit(m.root).cast("string").alias("root"),
                    mm.proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root")) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))


# CRC-32 by its table of 256 remainders, over a list of byte values
CRC_TABLE_SQL = """crc AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x:
  CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab)"""


def _crc_sql(codes: str) -> str:
    return (f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), "
            "lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)")


def _merkle_sql(name: str, base: str, heights: int = 8) -> str:
    """``base`` (grp, id, r, node, n) level by level, up to 16 ** heights leaves a group: top node and path of every id."""
    sql = f"{name}0 AS (SELECT *, CAST([] AS STRUCT(l VARCHAR, r VARCHAR, f VARCHAR)[]) AS path FROM {base})"
    for h in range(heights):
        sql += f""",
{name}k{h} AS (SELECT grp, r // 16 AS p, list(node ORDER BY r) AS kids
  FROM (SELECT DISTINCT grp, r, node FROM {name}{h} WHERE n > 1) GROUP BY 1, 2),
{name}{h + 1} AS (SELECT t.grp, t.id, t.r // 16 AS r, coalesce(sha256(array_to_string(kids, '')), node) AS node, (n + 15) // 16 AS n,
  CASE WHEN kids IS NULL THEN path ELSE list_append(path, {{'l': coalesce(array_to_string(kids[1 : t.r % 16], ''), ''),
    'r': coalesce(array_to_string(kids[t.r % 16 + 2 : 16], ''), ''), 'f': ''}}) END AS path
  FROM {name}{h} t LEFT JOIN {name}k{h} k ON k.grp = t.grp AND k.p = t.r // 16)"""
    return sql + f",\n{name} AS (SELECT grp, id, node, path FROM {name}{heights})"


def _op11_sql() -> str:
    part = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END"
    leaf = lambda text: "sha256(" + " || ".join(map(part, (*LEAF_COLUMNS[:-1], text))) + ")"
    codes = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))"
    return f"""
WITH {CRC_TABLE_SQL},
a AS (SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS grp, {leaf("text")} AS leaf,
             CASE WHEN {_crc_sql(codes)} % 5 = 0 THEN {leaf(ASCII_LOWER_SQL.format("text"))} END AS tampered
      FROM documents, crc),
b AS (SELECT *, row_number() OVER (ORDER BY grp, doc_id NULLS FIRST, leaf) AS id FROM a),
base AS (SELECT grp, id, row_number() OVER (PARTITION BY grp ORDER BY id) - 1 AS r, leaf AS node,
                count(*) OVER (PARTITION BY grp) AS n FROM b),
{_merkle_sql("d", "base")},
subroots AS (SELECT DISTINCT grp, node FROM d),
subs AS (SELECT 0 AS grp, grp AS id, grp AS r, node, count(*) OVER () AS n FROM subroots),
{_merkle_sql("s", "subs")},
p AS (SELECT b.*, d.node AS subroot, s.node AS root, list_concat(d.path, s.path) AS path
      FROM b JOIN d ON d.id = b.id JOIN s ON s.id = b.grp),
f AS (SELECT *, list_reduce(list_prepend({{'l': '', 'r': '', 'f': coalesce(tampered, leaf)}}, path),
               lambda x, y: {{'l': '', 'r': '', 'f': sha256(y.l || x.f || y.r)}}).f AS folded_root FROM p)
SELECT doc_id, leaf, subroot, root,
       sha256(coalesce(array_to_string(list_transform(path, lambda x: x.l || x.r), ''), '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM f"""


# -- op12 --------------------------------------------------------------------------------------
def op12_cover_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = cd.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return r.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id, 9223372036854775807) AS k,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT rid, k, s, array_to_string(w[s : s + 12], ' ') AS phrase
        FROM (SELECT rid, k, w, unnest(range(1, len(w) - 11)) AS s FROM d)),
first AS (SELECT phrase, min(k) AS k FROM win GROUP BY phrase),
gone AS (SELECT DISTINCT rid, unnest(range(s, s + 13)) AS i FROM win JOIN first USING (phrase) WHERE win.k > first.k),
words AS (SELECT rid, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d),
r AS (SELECT rid, count(gone.i) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone.i IS NULL) AS kept
      FROM words LEFT JOIN gone USING (rid, i) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN r USING (rid)"""


# -- op13 --------------------------------------------------------------------------------------
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sg.variants(table(spark, sf_dir, "documents", "doc_id", "text")).select(
        "word", "form", "root", "n", "n_near", "form_n")


# a run's UTF-8 bytes: its letters lie below U+0100
_OP13_CODES = """flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''), lambda x:
  CASE WHEN ord(x) < 128 THEN [CAST(ord(x) AS BIGINT)] ELSE [CAST(192 + (ord(x) >> 6) AS BIGINT), CAST(128 + (ord(x) & 63) AS BIGINT)] END))"""

OP13_SQL = rf"""
WITH RECURSIVE {CRC_TABLE_SQL},
runs AS (SELECT doc_id, run, count(*) AS n
         FROM (SELECT doc_id, unnest(regexp_extract_all({ASCII_LOWER_SQL.format("text")}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents)
         WHERE length(run) >= 6 GROUP BY doc_id, run),
hashed AS (SELECT run, n, {_crc_sql(_OP13_CODES)} AS h FROM runs, crc),
edited AS (SELECT CASE WHEN h % 199 = 0 THEN run[1 : h % length(run)] || run[h % length(run) + 2 : length(run)] ELSE run END AS word, n
           FROM hashed),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM edited WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
holes AS (SELECT word, i, word[1 : i - 1] AS a, word[i + 1 : length(word)] AS b
          FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
near AS (SELECT x.word, y.word AS other FROM holes x JOIN holes y ON x.a = y.a AND x.b = y.b AND x.word <> y.word
         UNION SELECT h.word, v.word FROM holes h JOIN v ON v.word = h.a || h.b
         UNION SELECT v.word, h.word FROM holes h JOIN v ON v.word = h.a || h.b),
ranked AS (SELECT near.word, other, v.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near,
                  row_number() OVER (PARTITION BY near.word ORDER BY v.n DESC, other) AS place
           FROM near JOIN v ON v.word = near.other),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * v.n THEN other END AS form,
             CASE WHEN other_n >= 5 * v.n THEN other_n END AS form_n
      FROM v LEFT JOIN ranked ON ranked.word = v.word AND place = 1),
way AS (SELECT word, word AS root FROM f
        UNION ALL SELECT way.word, f.form FROM way JOIN f ON f.word = way.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, way.root, f.n, f.n_near, f.form_n
FROM f JOIN way ON way.word = f.word JOIN f AS last ON last.word = way.root AND last.form IS NULL"""


QUERIES = {
    "op1_dart_minhash": op1_dart_minhash,
    "op2_nnls_packing": op2_nnls_packing,
    "op3_line_dedup": op3_line_dedup,
    "op4_preference_format": op4_preference_format,
    "op4_shared_prefix": op4_shared_prefix,
    "op5_decontaminate": op5_decontaminate,
    "op5_proximity": op5_proximity,
    "op6_repetition": op6_repetition,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_secret_scan": op9_secret_scan,
    "op9_rescan": op9_rescan,
    "op10_cotrain_quality": op10_cotrain_quality,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_cover_dedup": op12_cover_dedup,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLES = {
    "op3_line_dedup": OP3_SQL,
    "op4_preference_format": OP4_SQL,
    "op4_shared_prefix": OP4_SHARED_SQL,
    "op5_decontaminate": OP5_SQL,
    "op9_secret_scan": _op9_sql(),
    "op9_rescan": f"""
WITH found AS ({_op9_sql()})
SELECT found.*, CAST(CASE WHEN coalesce(documents.text, '') IN (SELECT coalesce(text, '') FROM documents WHERE doc_id % 2 = 0)
                          THEN 1 ELSE {len(ss.RULES)} END AS BIGINT) AS n_scanned
FROM found JOIN documents ON documents.doc_id = found.doc_id""",
    "op11_merkle_manifest": _op11_sql(),
    "op12_cover_dedup": OP12_SQL,
    "op13_spelling_variants": OP13_SQL,
}
