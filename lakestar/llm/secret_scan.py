"""Secret scan: fixed patterns, and sliding-window entropy over candidate strings (DataFrame functions only).

Three base kinds are regular expressions, leftmost and without overlap for each kind, with a least length. The method adds
spans. A candidate is a run of ``WINDOW`` or more characters of one class (hexadecimal digits; base64
characters). A window slides over it; the counts of its characters and the sum of c * log2(c) over them are
kept from one step to the next, as one character leaves and one enters. The Shannon entropy is
log2(WINDOW) - sum / WINDOW, so a window is a find if the sum is at most the class's limit. Finds that overlap or
touch are one span. Candidates on the allow list (words, numbers, UUIDs, paths, placeholders,
alphabets) add nothing; it never takes a base span away.

Sums are whole numbers (millionths), so steps add up without drift. A long candidate is cut into
pieces of ``STEP`` windows, so the work follows its length. All is one projection: nothing is
shuffled, and each row is answered by itself. A null text is empty; null ids and repeated rows are kept.
Positions are code points, ends exclusive.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the base kinds, in their order
BASE = [
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    ("access", r"AKIA[A-Z0-9]+", 16, 0),
    ("hex", r"[0-9a-f]+", 32, 0),
]
WINDOW = 20
STEP = 256  # windows of one piece of a candidate
RUN = 256   # entries of one run of a running sum
UNIT = 1_000_000
# kind: its characters as a class, the same spelled out, the least entropy of a find in bits a character
CLASSES = {
    "entropy_hex": ("0-9A-Fa-f", "0123456789ABCDEFabcdef", 3.0),
    "entropy_base64": ("A-Za-z0-9+/_=-", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.75),
}
ALLOWED = [
    r"^[0-9]+$",
    r"^[A-Z]?[a-z]+$|^[A-Z]+$",
    r"^[/_-]*[A-Za-z]{1,15}([/_-]+[A-Za-z]{1,15})+[/_-]*$",
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"0123456789|abcdefghij|ABCDEFGHIJ",
    r"(?i:example|sample|placeholder|changeme|dummy|xxxx)",
]
KINDS = [kind for kind, *_ in BASE] + list(CLASSES)


def weights(window: int = WINDOW) -> list[int]:
    """c * log2(c) in millionths for every count c of a window."""
    return [0] + [round(UNIT * c * math.log2(c)) for c in range(1, window + 1)]


def limit(bits: float, window: int = WINDOW) -> int:
    return math.floor(UNIT * window * (math.log2(window) - bits))


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)``, with the value worked out once however often it is used."""
    return F.transform(F.array(value), then)[0]


def running(steps: Column) -> Column:
    """Running sums of an array of numbers, by runs, so that a long one is not copied at every entry."""
    def sums(xs: Column, start: Column) -> Column:
        return F.aggregate(xs, F.array(start), lambda done, x: F.concat(done, F.array(F.element_at(done, -1) + x)))

    def by_runs(xs: Column) -> Column:
        runs = F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / RUN).cast("int"))
        run = lambda b: F.slice(xs, b * RUN + 1, F.lit(RUN))
        starts = sums(F.transform(runs, lambda b: F.aggregate(run(b), F.lit(0), lambda s, x: s + x)), F.lit(0))
        return let(starts, lambda at: F.flatten(F.transform(runs, lambda b: F.slice(sums(run(b), at[b]), F.lit(2), F.lit(RUN)))))

    return let(steps, by_runs)


SPOT = "array<struct<at:int,hit:string>>"


def located(text: Column, pattern: str) -> Column:
    """The pattern's matches in ``text``, leftmost and without overlap: where each begins, and what it is."""
    both = F.struct(F.transform(F.split(text, pattern, -1), F.char_length).alias("gaps"),
                    F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"))

    def placed(x: Column) -> Column:
        steps = F.transform(x["hits"], lambda h, i: x["gaps"][i] + F.when(i > 0, F.char_length(x["hits"][F.greatest(i - 1, F.lit(0))])).otherwise(0))
        return let(running(steps), lambda at: F.transform(x["hits"], lambda h, i: F.struct(at[i].alias("at"), h.alias("hit"))))

    return F.when(F.regexp_like(text, F.lit(pattern)), let(both, placed)).otherwise(F.array().cast(SPOT))


def _span(kind: str, start: Column, end: Column) -> Column:
    return F.struct(start.cast("int").alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.cast("int").alias("end"))


def base_spans(text: Column, kind: str, pattern: str, least: int, group: int) -> Column:
    counted = (lambda hit: F.char_length(F.regexp_extract(hit, pattern, group))) if group else F.char_length
    if not group:  # a run that is long enough begins where the whole run does, so shorter ones need not be taken up
        pattern = f"{pattern[:-1]}{{{least - (4 if kind == 'access' else 0)},}}"
    return F.transform(F.filter(located(text, pattern), lambda x: counted(x["hit"]) >= least),
                       lambda x: _span(kind, x["at"], x["at"] + F.char_length(x["hit"])))


def windows(piece: Column, alphabet: str, most: int, window: int = WINDOW) -> Column:
    """Runs of neighbouring windows of ``piece`` whose sum is at most ``most``: (first, last) window numbers."""
    table = F.array(*[F.lit(x).cast("bigint") for x in weights(window)])
    none = F.array().cast("array<struct<first:int,last:int>>")

    def slide(codes: Column) -> Column:
        counts = F.transform(F.sequence(F.lit(1), F.lit(len(alphabet))),
                             lambda k: F.size(F.filter(F.slice(codes, 1, window), lambda c: c == k)))

        def begun(held: Column) -> Column:
            total = F.aggregate(held, F.lit(0).cast("bigint"), lambda s, n: s + table[n])
            return let(total, lambda s: F.struct(held.alias("counts"), s.alias("sum"), F.when(s <= most, 0).otherwise(-1).alias("first"),
                                                 none.alias("runs")))

        def step(state: Column, i: Column) -> Column:
            gone, come = codes[i - 1], codes[i + window - 1]
            n_gone, n_come = state["counts"][gone - 1], state["counts"][come - 1]
            moved = table[n_gone - 1] - table[n_gone] + table[n_come + 1] - table[n_come]
            total = state["sum"] + F.when(gone == come, F.lit(0).cast("bigint")).otherwise(moved)
            counts = F.when(gone == come, state["counts"]).otherwise(F.transform(
                state["counts"], lambda n, k: n + (k == come - 1).cast("int") - (k == gone - 1).cast("int")))
            return let(total, lambda s: F.struct(
                counts.alias("counts"), s.alias("sum"),
                F.when(s > most, -1).when(state["first"] < 0, i).otherwise(state["first"]).alias("first"),
                F.when((s > most) & (state["first"] >= 0), F.concat(state["runs"], F.array(
                    F.struct(state["first"].alias("first"), (i - 1).alias("last"))))).otherwise(state["runs"]).alias("runs")))

        n = F.size(codes) - window + 1
        return F.when(n < 1, none).otherwise(F.aggregate(
            F.filter(F.sequence(F.lit(0), n - 1), lambda i: i > 0), let(counts, begun), step,
            lambda end: F.when(end["first"] < 0, end["runs"]).otherwise(F.concat(end["runs"], F.array(
                F.struct(end["first"].alias("first"), (n - 1).alias("last")))))))

    return let(F.transform(F.split(piece, ""), lambda c: F.instr(F.lit(alphabet), c)), slide)


def entropy_spans(text: Column, kind: str, window: int = WINDOW) -> Column:
    chars, alphabet, bits = CLASSES[kind]
    allowed = "|".join(f"(?:{x})" for x in ALLOWED)
    candidates = F.filter(located(text, f"[{chars}]{{{window},}}"), lambda c: ~F.regexp_like(c["hit"], F.lit(allowed)))
    cut = lambda c: F.transform(
        F.sequence(F.lit(0), F.floor((F.char_length(c["hit"]) - window) / STEP).cast("int")),
        lambda k: F.struct((c["at"] + k * STEP).alias("at"),
                           F.substring(c["hit"], k * STEP + 1, F.lit(STEP + window - 1)).alias("piece")))
    found = F.flatten(F.transform(F.flatten(F.transform(candidates, cut)), lambda p: F.transform(
        windows(p["piece"], alphabet, limit(bits, window), window),
        lambda w: F.struct((p["at"] + w["first"]).alias("start"), (p["at"] + w["last"] + window).alias("end")))))

    def merged(xs: Column) -> Column:
        """Starts and ends both ascend, so a span goes on where the next one begins at or before its end."""
        n = F.size(xs)
        heads = F.filter(xs, lambda x, i: (i == 0) | (x["start"] > xs[F.greatest(i - 1, F.lit(0))]["end"]))
        tails = F.filter(xs, lambda x, i: (i == n - 1) | (xs[F.least(i + 1, n - 1)]["start"] > x["end"]))
        return let(tails, lambda t: F.transform(heads, lambda x, i: _span(kind, x["start"], t[i]["end"])))

    return let(found, merged)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, added): arrays of (start, kind, end), kind as a place in ``KINDS``, by start, then kind."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = F.array_sort(F.concat(*[base_spans(F.col("x"), *one) for one in BASE]))
    added = F.array_sort(F.concat(*[entropy_spans(F.col("x"), kind) for kind in CLASSES]))
    return docs.select(F.col(id_col).alias("id"), text.alias("x")).select(
        F.col("id").alias(id_col), base.alias("base"), added.alias("added"))


def named(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def op11_secret_scan(spark, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id", n("assign"), n("access"), n("hex"), F.sha2(named(F.col("base")), 256).alias("base_sha256"),
        named(F.array_sort(F.concat("base", "added"))).alias("spans"))


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _sql() -> str:
    """The same by plain windows: every window is counted anew."""
    assign = "|".join(_either(x) for x in ("password", "passwd", "secret", "token", "api_?key"))
    patterns = {"assign": f"""({assign})["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)""", "access": BASE[1][1], "hex": BASE[2][1]}
    patterns |= {kind: f"[{chars}]{{{WINDOW},}}" for kind, (chars, *_) in CLASSES.items()}
    spots = " UNION ALL ".join(
        f"SELECT r, {KINDS.index(kind)} AS kind, string_split_regex(x, '{p}') AS gaps, regexp_extract_all(x, '{p}', 0) AS hits FROM t"
        for kind, p in patterns.items())
    enough = (f"CASE kind WHEN 0 THEN length(regexp_extract(hit, '{patterns['assign']}', 2)) >= 8 "
              "WHEN 1 THEN length(hit) >= 16 ELSE length(hit) >= 32 END")
    allowed = "|".join(f"(?:{x})" for x in ALLOWED)
    most = " ".join(f"WHEN {KINDS.index(kind)} THEN {limit(bits)}" for kind, (_, _, bits) in CLASSES.items())
    name = " ".join(f"WHEN {i} THEN '{kind}'" for i, kind in enumerate(KINDS))
    count = ", ".join(f"(count(*) FILTER (kind = {i}))::BIGINT AS n_{KINDS[i]}" for i in range(3))
    return f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS x FROM documents),
h AS ({spots}),
m AS (
  SELECT r, kind, hits[i] AS hit, list_sum(list_transform(gaps[1:i], lambda g: length(g)))
         + coalesce(list_sum(list_transform(hits[1:i - 1], lambda g: length(g))), 0) AS pos
  FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM h)),
c AS (
  SELECT r, kind, pos, hit, unnest(range(0, length(hit) - {WINDOW} + 1)) AS k FROM m
  WHERE kind >= 3 AND NOT regexp_matches(hit, '{allowed}')),
w AS (
  SELECT r, kind, pos + k AS s, pos + k + {WINDOW} AS e FROM c
  WHERE list_sum(list_transform(map_values(list_histogram(string_split(substring(hit, k + 1, {WINDOW}), ''))),
                                lambda n: round({UNIT} * n * log2(n)))) <= CASE kind {most} END),
g AS (SELECT *, coalesce(s > max(e) OVER (PARTITION BY r, kind ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS fresh FROM w),
i AS (SELECT *, sum(fresh::INT) OVER (PARTITION BY r, kind ORDER BY s) AS n FROM g),
a AS (
  SELECT r, kind, pos AS s, pos + length(hit) AS e FROM m WHERE kind < 3 AND {enough}
  UNION ALL SELECT r, kind, min(s), max(e) FROM i GROUP BY r, kind, n),
j AS (SELECT *, CASE kind {name} END || ':' || s::BIGINT || ':' || e::BIGINT AS told FROM a)
SELECT any_value(doc_id) AS doc_id, {count},
       sha256(coalesce(string_agg(told, ',' ORDER BY s, kind) FILTER (kind < 3), '')) AS base_sha256,
       coalesce(string_agg(told, ',' ORDER BY s, kind), '') AS spans
FROM t LEFT JOIN j USING (r) GROUP BY r
"""


OP11_SQL = _sql()
