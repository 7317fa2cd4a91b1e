"""Secrets in texts: three fixed patterns, and strings that look random to character Markov models.

One model knows random strings, the other ordinary identifiers; both are first-order chains over
characters, trained on what the patterns label in the corpus: values they matched against all other
long tokens. A token is a secret if its log-likelihood ratio is high. All of it is DataFrame functions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from priceloom.llm.text import apart
from priceloom.session import settle

# The patterns. In hex and access the length is part of the pattern, which changes nothing: both match
# whole runs, and what is too short at the start of a run is too short later in it.
KINDS = ["assign", "access", "hex", "random"]
ASSIGN = (
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
#: Tokens the models judge.
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-"

_SPAN = "array<struct<start:int,kind:int,end:int>>"


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, found>> of the leftmost non-overlapping matches; positions are code points.

    split() and regexp_extract_all() walk the same matches: the text between them and they themselves.
    """
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 0)
    empty = F.array().cast("array<struct<start:int,end:int,found:string>>")

    def step(done: Column, pair: Column) -> Column:
        start = done["at"] + F.length(pair["between"])
        end = start + F.length(pair["found"])
        span = F.struct(start.alias("start"), end.alias("end"), pair["found"].alias("found"))
        return F.struct(end.alias("at"), F.concat(done["spans"], F.array(span)).alias("spans"))

    pairs = F.arrays_zip(F.slice(between, 1, F.size(found)).alias("between"), found.alias("found"))
    walked = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), empty.alias("spans")), step)["spans"]
    return F.when(text.rlike(pattern), walked).otherwise(empty)


def _as_span(kind: int):
    return lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end"))


def mark(docs: DataFrame) -> DataFrame:
    """``docs`` with _base (spans of the patterns) and _tokens: long tokens, whether a base span meets them, and whether it leaves part of them."""
    text = F.coalesce(F.col("text"), F.lit(""))
    valued = F.filter(
        matches(text, ASSIGN), lambda m: F.length(F.regexp_extract(m["found"], ASSIGN, 2)) >= ASSIGN_VALUE
    )
    found = [valued, matches(text, ACCESS), matches(text, HEX)]
    spans = [F.transform(f, _as_span(kind)) for kind, f in enumerate(found)]
    marked = docs.withColumns({"_base": F.array_sort(F.concat(*spans)), "_tokens": matches(text, TOKEN)})
    base = F.col("_base")
    tokens = F.transform(
        "_tokens",
        lambda t: F.struct(
            t["start"].alias("start"), t["end"].alias("end"), t["found"].alias("token"),
            F.exists(base, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])).alias("base"),
            (
                F.exists(base, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))
                & ~F.exists(base, lambda b: (b["start"] <= t["start"]) & (t["end"] <= b["end"]))
            ).alias("mixed"),
        ),
    )
    return marked.withColumn("_tokens", tokens)


@dataclass
class Chains:
    """``ratio[a * K + b]``: log of how much likelier b follows a in a random string than in an identifier.

    A token is random if its ratios sum to ``least``, and to ``least_each`` on average.
    """

    ratio: list[float]
    least: float = 10.0
    least_each: float = 1.2

    def random(self, token: Column) -> Column:
        return self.score(token) >= F.greatest(F.lit(self.least), (F.length(token) - 1) * F.lit(self.least_each))

    def score(self, token: Column) -> Column:
        table = F.split(F.lit(",".join(f"{r:.5f}" for r in self.ratio)), ",").cast("array<double>")
        code = lambda i: F.instr(F.lit(ALPHABET), F.substring(token, i, F.lit(1)))
        follow = F.sequence(F.lit(1), F.length(token) - 1)
        return F.aggregate(
            follow, F.lit(0.0), lambda sum, i: sum + F.get(table, (code(i) - 1) * len(ALPHABET) + code(i + 1) - 1)
        )


def learn(marked: DataFrame, prior: float = 16.0) -> Chains:
    """Both chains, from all distinct long tokens of ``marked``: inside a base span, or met by none.

    After each character ``prior`` more are added, spread as characters are overall: what identifiers never
    hold stays unlikely in places they never showed. Random strings take half of their chances evenly
    from the alphabet, since the labelled ones have only some of its kinds.
    """
    tokens = marked.select(F.explode("_tokens").alias("t")).where("NOT t.mixed").select("t.token", "t.base").distinct()
    pairs = tokens.select(
        "base", F.explode(F.transform(F.sequence(F.lit(1), F.length("token") - 1), lambda i: F.substring(F.col("token"), i, F.lit(2)))).alias("pair")
    )
    counts = {(r["base"], r["pair"]): r["count"] for r in pairs.groupBy("base", "pair").count().collect()}  # K x K x 2
    size = len(ALPHABET)
    after = {(kind, a): sum(counts.get((kind, a + b), 0) for b in ALPHABET) for kind in (True, False) for a in ALPHABET}
    seen = {(kind, b): sum(counts.get((kind, a + b), 0) for a in ALPHABET) for kind in (True, False) for b in ALPHABET}
    whole = {kind: sum(seen[kind, b] for b in ALPHABET) for kind in (True, False)}

    def chance(kind: bool, a: str, b: str) -> float:
        overall = (seen[kind, b] + 0.5) / (whole[kind] + 0.5 * size)
        return (counts.get((kind, a + b), 0) + prior * overall) / (after[kind, a] + prior)

    random = lambda a, b: 0.5 * chance(True, a, b) + 0.5 / size
    return Chains([math.log(random(a, b) / chance(False, a, b)) for a in ALPHABET for b in ALPHABET])


def spans(marked: DataFrame, chains: Chains) -> DataFrame:
    """``marked`` with _spans: the base spans and the tokens not inside one that the chains find random, as a whole."""
    own = F.filter("_tokens", lambda t: (~t["base"] | t["mixed"]) & chains.random(t["token"]))
    added = F.transform(own, _as_span(KINDS.index("random")))
    return marked.withColumn("_spans", F.array_sort(F.concat("_base", added)).cast(_SPAN))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans): the secrets of each row's whole text, as array<struct<start, kind, end>>.

    ``kind`` indexes KINDS; positions are code points, ends exclusive; spans are sorted by start, then
    kind. Null and empty texts have none; repeated rows are scanned each; other columns are ignored; an
    empty table gives none.
    """
    marked = settle(mark(docs.select("doc_id", "text")).drop("text"), "marked")
    found = spans(marked, learn(marked))
    return found.select("doc_id", F.col("_base").alias("base"), F.col("_spans").alias("spans"))


def written(found: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redact(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mask`` and ``n_chars``, if there, counted anew.

    Overlapping spans become one mask. Rows without secrets stay as they are, null and empty texts among them.
    Columns keep their names, whatever they are; repeated rows stay; an empty table gives none.
    """
    (row,) = apart(docs, "row")
    # All columns travel in one struct: none can meet a name that is used here.
    told = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row)
    marked = settle(mark(docs.select(told, "text")).select(row, "_base", "_tokens"), "marked")
    found = spans(marked, learn(marked))
    text = F.col(row)["text"]

    def step(done: Column, span: Column) -> Column:
        start, end = span["start"], span["end"]
        clear = F.substring(text, done["at"] + 1, start - done["at"])
        return F.struct(
            F.greatest(done["at"], end).alias("at"),
            F.when(start >= done["at"], F.concat(done["out"], clear, F.lit(mask))).otherwise(done["out"]).alias("out"),
        )

    walked = F.aggregate("_spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step)
    found = found.withColumn("_walked", F.when(F.size("_spans") > 0, walked))
    rest = F.substring(text, F.col("_walked")["at"] + 1, F.length(text))
    found = found.withColumn("_clean", F.concat(F.col("_walked")["out"], rest))
    touched = F.col("_clean").isNotNull()

    def column(name: str, kind: str) -> Column:
        value = F.col(row)[name]
        if name == "text":
            value = F.when(touched, F.col("_clean")).otherwise(value)
        elif name == "n_chars":
            value = F.when(touched, F.length("_clean").cast(kind)).otherwise(value)
        return value.alias(name)

    return found.select(*[column(c, kind) for c, kind in docs.dtypes])
