import random
import re

from pyspark.sql import functions as F

from priceloom.llm import secret_scan
from tests.llm.data import DOCS, documents, prose

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def plain(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def texts():
    rng = random.Random(1)
    hexa = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    key = lambda n: "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(n))
    out = []
    for i in range(60):
        words = prose(rng, 60).split()
        words.insert(rng.randrange(60), [f'token = "{hexa(40)}"', f"password={hexa(18)}", key(16), "identifier_of_the_thing"][i % 4])
        out.append(" ".join(words))
    return out + [
        None, "", "secret=token:abcdefgh", "secret=a:token", "token=token=abcdefgh", "PassWord : 'x/y+z==' api_key=12345 APIKEY=123456",
        "😀é " + key(16) + key(15) + " " + hexa(24) + "g" + hexa(23) + " A" + hexa(30), "password=" + hexa(30) + "\npasswd=\"short\"",
        key(15) + "AKIA", "token=" * 300 + "x", hexa(5000), prose(rng, 20_000) + " " + key(20),
        "note Zk39qLmX82pQrT7vNw0sHd5 and internationalization_of_names",
    ]


def test_base_spans_equal_plain_matches(spark):
    rows = texts()
    found = {r["doc_id"]: r for r in secret_scan.scan(documents(spark, rows)).collect()}
    assert len(found) == len(rows)
    for i, text in enumerate(rows):
        want = plain(text or "")
        assert [(s["start"], s["kind"], s["end"]) for s in found[i]["base"]] == want, text
        spans = [(s["start"], s["kind"], s["end"]) for s in found[i]["spans"]]
        assert set(want) <= set(spans) and spans == sorted(spans)


def test_the_chains_tell_random_strings_from_identifiers(spark):
    rng = random.Random(2)
    rows = [prose(rng, 2000).replace(" ", "") for _ in range(2)] + texts()
    rows[:2] = [" ".join(t[i : i + 18] for i in range(0, len(t), 18)) for t in rows[:2]]
    marked = secret_scan.mark(documents(spark, rows).select("doc_id", "text"))
    chains = secret_scan.learn(marked.where(f"doc_id < {len(rows) - 1}"))
    found = {r["doc_id"]: r["_spans"] for r in secret_scan.spans(marked, chains).collect()}
    assert [rows[-1][s["start"] : s["end"]] for s in found[len(rows) - 1]] == ["Zk39qLmX82pQrT7vNw0sHd5"]
    assert found[0] == found[1] == []


def test_a_random_token_around_a_base_span_is_judged_whole(spark):
    rng = random.Random(3)
    prefix = [prose(rng, 2000).replace(" ", "") for _ in range(2)]
    rows = [" ".join(t[i : i + 18] for i in range(0, len(t), 18)) for t in prefix] + texts()
    hidden = "Qm7X" + "0f3a9c1e5b7d2846a0c9e3f1" + "XyZ9Qm2LpW8vKr4T"
    rows += [f"note {hidden} here", "internationalization_of_api_key=abcdefgh"]
    docs = documents(spark, rows)
    found = {r["doc_id"]: r for r in secret_scan.scan(docs).collect()}
    mine, other = found[len(rows) - 2], found[len(rows) - 1]
    assert [(s["start"], s["kind"], s["end"]) for s in mine["base"]] == [(9, 2, 33)]
    assert [(s["start"], s["kind"], s["end"]) for s in mine["spans"]] == [(5, 3, 5 + len(hidden)), (9, 2, 33)]
    assert other["spans"] == other["base"] and len(other["base"]) == 1
    masked = {r["doc_id"]: r["text"] for r in secret_scan.redact(docs).collect()}
    assert masked[len(rows) - 2] == "note [SECRET] here"


def test_redaction(spark):
    rows = texts()
    docs = documents(spark, rows)
    spans = {r["doc_id"]: r["spans"] for r in secret_scan.scan(docs).collect()}
    done = secret_scan.redact(docs)
    assert done.columns == docs.columns
    for r in done.collect():
        text, out, at = rows[r["doc_id"]], "", 0
        for s in spans[r["doc_id"]]:
            if s["start"] >= at:
                out += text[at : s["start"]] + "[SECRET]"
            at = max(at, s["end"])
        assert r["text"] == (None if text is None else out + text[at:])
        assert r["n_chars"] == len(r["text"] or "")


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert secret_scan.scan(empty).count() == secret_scan.redact(empty).count() == 0


def test_any_column_name(spark):
    names = ["_key", "_id", "_position", "_last", "_base", "_tokens", "_spans", "_walked", "_clean", "row", "copies"]
    docs = documents(spark, ["one text of words", "password = hunter2hunter2", None, ""])
    docs = docs.withColumns({n: F.concat(F.lit(n), "doc_id") for n in names})
    got = secret_scan.redact(docs)
    assert got.columns == docs.columns and got.count() >= 1
    assert all(r[n] == f"{n}{r['doc_id']}" for r in got.collect() for n in names)
