"""Secret scans with an incremental blob ledger (DataFrame only).

Every version of every path is content-addressed (sha256 of its text).  A ledger row
(blob, rule, version, spans) says that a rule version has been run on a blob; a scan takes only
the (blob, rule version) pairs the ledger lacks, and findings join back to all paths that hold
the blob.  A blob copied to thousands of paths is read once.

Spans are code-point offsets, end exclusive.  A rule's matches are found leftmost and
non-overlapping with one ``regexp_replace`` that brackets them by control characters (which no
rule's pattern can match; the text's own ones are first replaced by a third, so lengths hold).

Edge cases: null content is empty; repeated (path, version) rows give repeated result rows;
null paths are kept; an empty table gives empty results; other columns are never touched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import written

CHUNK = 64      # parts whose spans are gathered at once (an even number)
MARK, INNER, OTHER = "\x01", "\x02", "\x03"
SPAN = "array<struct<start:int,end:int,ord:int,kind:string>>"
LEDGER = f"blob string, rule string, version int, spans {SPAN}"


@dataclass(frozen=True)
class Rule:
    """``min_chars`` applies to group ``group`` of a match (0: the whole match)."""
    kind: str
    pattern: str
    group: int = 0
    min_chars: int = 1
    version: int = 1


BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         group=2, min_chars=6),
    Rule("access", r"AKIA[A-Z0-9]+", min_chars=20),
    # a run of 24 and more is always the whole run, so the bound may stand in the pattern
    Rule("hex", r"[0-9a-f]{24,}", min_chars=24),
)

EXTRA_RULES = (
    # to the END line over the characters of key files (single hyphens among them), else to the end of the base64
    # block; a scan ends at the next two hyphens, so many BEGIN marks cost no more than their texts.  Possessive
    # repeats keep Java's matcher from recursing
    Rule("private_key", r"-----BEGIN [A-Z\x20]*PRIVATE KEY-----"
         r"(?:[A-Za-z0-9+/=:;,._\\()\x20\t\r\n]*+(?:-[A-Za-z0-9+/=:;,._\\()\x20\t\r\n]++)*+-----END [A-Z\x20]*PRIVATE KEY-----"
         r"|[\x20\t\r\n]*[A-Za-z0-9+/=]{16,}[A-Za-z0-9+/=\r\n]*|)", version=3),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("forge_token", r"(?:gh[pousr]_[A-Za-z0-9]{36,}|glpat-[A-Za-z0-9_-]{20,})"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,20}://[^\x00-\x20/:@\"'<>]+:[^\x00-\x20/:@\"'<>]{3,}@", version=2),
)

RULES = BASE_RULES + EXTRA_RULES


def bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def chunk_spans(parts: Column, rule: Rule, order: int) -> Column:
    """Width of some parts (every second one is a match), and the spans of their good matches from the first part on."""
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("i"), F.array().cast(SPAN).alias("out"))

    def step(acc: Column, part: Column) -> Column:
        pieces = F.split(part, INNER)
        hit = F.pmod(acc["i"], F.lit(2)) == 1
        end = acc["at"] + F.length(F.when(hit, pieces[0]).otherwise(part))
        span = F.struct(acc["at"].alias("start"), end.alias("end"), F.lit(order).alias("ord"), F.lit(rule.kind).alias("kind"))
        good = hit & (F.length(pieces[1]) >= rule.min_chars)
        out = F.when(good, F.concat(acc["out"], F.array(span).cast(SPAN))).otherwise(acc["out"])
        return F.struct(end.alias("at"), (acc["i"] + 1).alias("i"), out.alias("out"))

    return F.aggregate(parts, start, step, lambda acc: F.struct(acc["at"].alias("width"), acc["out"].alias("spans")))


def part_spans(parts: Column, rule: Rule, order: int) -> Column:
    """Spans of all parts: CHUNK parts at a time, moved by the widths of the chunks before."""
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / CHUNK).cast("int")),
                         lambda c: chunk_spans(F.slice(parts, c * CHUNK + 1, F.lit(CHUNK)), rule, order))
    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    begun = lambda cs: F.aggregate(cs, none, lambda acc, c: F.struct(
        (acc["at"] + c["width"]).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])
    moved = lambda s, by: F.struct((s["start"] + by).alias("start"), (s["end"] + by).alias("end"), s["ord"], s["kind"])
    return bound(chunks, lambda cs: bound(begun(cs), lambda at: F.flatten(F.transform(
        cs, lambda c, i: F.transform(c["spans"], lambda s: moved(s, at[i]))))))


def rule_spans(text: Column, rule: Rule, order: int) -> Column:
    """Spans of one rule in a text whose control characters are already cleaned."""
    marked = F.regexp_replace(text, rule.pattern, f"{MARK}$0{INNER}${rule.group}{MARK}")
    found = bound(F.split(marked, MARK), lambda parts: part_spans(parts, rule, order))
    return F.when(text.rlike(rule.pattern), found.cast(SPAN)).otherwise(F.array().cast(SPAN))


def clean(text: Column) -> Column:
    return F.when(text.rlike(f"[{MARK}{INNER}]"), F.translate(text, MARK + INNER, OTHER * 2)).otherwise(text)


def address(history: DataFrame, path: str, version: str | None, content: str) -> DataFrame:
    """``path, version, blob, text`` of every stored version."""
    return history.select(F.col(path).alias("path"),
                          (F.col(version) if version else F.lit(0)).alias("version"),
                          F.coalesce(F.col(content), F.lit("")).alias("text")) \
        .withColumn("blob", F.sha2("text", 256))


def scan_unseen(stored: DataFrame, rules: tuple[Rule, ...] = RULES,
                ledger: DataFrame | None = None) -> DataFrame:
    """New ledger rows: every (blob, rule version) pair of ``stored`` that ``ledger`` lacks."""
    tags = [f"{r.kind}@{r.version}" for r in rules]
    row = F.xxhash64("path", "version")
    # one holder per blob: hashes only cross the network to choose it
    holder = stored.groupBy("blob").agg(F.min(row).alias("row"))
    if ledger is not None:
        seen = (ledger.select("blob", F.concat_ws("@", "rule", "version").alias("tag"))
                .where(F.col("tag").isin(tags)).groupBy("blob").agg(F.collect_set("tag").alias("seen")))
        holder = holder.join(seen, "blob", "left").where(
            F.coalesce(F.size("seen"), F.lit(0)) < len(tags))
    else:
        holder = holder.withColumn("seen", F.lit(None).cast("array<string>"))
    todo = stored.select("blob", row.alias("row"), "text").join(holder, ["blob", "row"])
    todo = todo.select("blob", clean(F.col("text")).alias("text"),
                       F.coalesce("seen", F.array().cast("array<string>")).alias("seen"))
    per_rule = [F.when(~F.array_contains("seen", tag), F.struct(
        F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version"),
        rule_spans(F.col("text"), r, i).alias("spans")))
        for i, (r, tag) in enumerate(zip(rules, tags, strict=True))]
    # a blob's copies of one path and version may give equal rows; they collapse here
    return (todo.select("blob", F.explode(F.filter(F.array(*per_rule), lambda x: x.isNotNull())).alias("x"))
            .select("blob", "x.rule", "x.version", "x.spans"))


def blob_spans(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per blob that has findings under the given rule versions: ``blob, spans`` sorted by
    start, then the rules' order."""
    tags = [f"{r.kind}@{r.version}" for r in rules]
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    now = (ledger.where(F.size("spans") > 0)
           .where(F.concat_ws("@", "rule", "version").isin(tags))
           .select("blob", F.explode("spans").alias("s"))
           .select("blob", F.struct(F.col("s.start").alias("start"),
                                    (F.array_position(kinds, F.col("s.kind")) - 1).cast("int").alias("ord"),
                                    F.col("s.end").alias("end"), F.col("s.kind").alias("kind")).alias("s")))
    return now.groupBy("blob").agg(F.sort_array(F.collect_set("s")).alias("spans"))


def findings(stored: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every path and version with its spans (an empty array where there are none)."""
    empty = F.array().cast("array<struct<start:int,ord:int,end:int,kind:string>>")
    # from a written table, so that the join's sides are plain shuffles and a blob at very many paths is split
    spans = written(blob_spans(ledger, rules), "secret-spans")
    return (stored.select("path", "version", "blob").join(spans, "blob", "left")
            .select("path", "version", "blob", F.coalesce("spans", empty).alias("spans")))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` comma-joined in the array's order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
