import hashlib
import random

import pytest
from hypothesis import given, settings, strategies as st

from priceloom.llm import queries, sentence_pieces
from tests.llm.data import documents, prose

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path(queries.PIECES)


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def table():
    return sentence_pieces.PrefixTable(PATH)


@pytest.mark.parametrize("shape", ["{}", "{}the", "a{}b", "\n{}.", "{}▁x "])
@pytest.mark.parametrize("filler", [" ", "▁", "a", "ing ", "0", "漢", "́", "\U0001f600", "\x00", "</s>"])
def test_runs(table, library, shape, filler):
    for n in [*range(20), 33, 64]:
        text = shape.format(filler * n)
        assert table.encode(text).tolist() == library.encode(text), text


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" ▁aeinrsthog.,\n\t019é漢"), st.characters(codec="utf-8")), max_size=60))
def test_any_text(table, library, text):
    ids = table.encode(text).tolist()
    assert ids == library.encode(text)
    assert table.decode(ids) == library.decode(ids)


def test_whole_text_in_one_chunk(table, library):
    """The cut at spaces saves time, not correctness: without it the table gives the same."""
    rng = random.Random(3)
    text = "▁" + prose(rng, 300).replace(" ", "▁")
    assert [table._piece[p] for p in table.pieces(text)] == library.encode(text[1:])


def test_forgetting_changes_nothing(library):
    small = sentence_pieces.PrefixTable(PATH)
    small.MOST, small.MOST_PAIRS, small.LONG = 3, 5, 6
    rng = random.Random(4)
    for _ in range(20):
        text = prose(rng, 40, rng.choice(["en", "de", "fr"]))
        assert small.encode(text).tolist() == library.encode(text)


def test_table_of_texts(spark, library):
    rng = random.Random(5)
    texts = [None, "", " ", "x", "x", prose(rng, 30_000), "no" * 20_000, "Ünï ▁ 漢字", "a\x00b"]
    docs = documents(spark, texts, extra=[(0, "twice", None, None, 0, 0.0, "x"), (None, "no id", None, None, 0, 0.0, "x")])
    docs = docs.withColumns({"ids": docs.text, "key": docs.text, "decoded": docs.text})
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["ids"], r["decoded"]) for r in
                 sentence_pieces.encode(docs, queries.PIECES, decoded=True).collect())
    want = sorted((r["doc_id"] is None, r["doc_id"] or 0, ids := library.encode(r["text"] or ""), library.decode(ids)) for r in docs.collect())
    assert got == want
    back = sentence_pieces.decode(sentence_pieces.encode(docs, queries.PIECES), queries.PIECES)
    assert sorted(r["text"] for r in back.collect()) == sorted(w[3] for w in want)
    assert sentence_pieces.encode(docs.limit(0), PATH).collect() == []


def test_null_ids_decode_to_null(spark):
    rows = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert sorted(tuple(r) for r in sentence_pieces.decode(rows, PATH).collect()) == [(1, None), (2, "")]


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as proto

    with open(PATH, "rb") as file:
        model = proto.ModelProto.FromString(file.read())
    model.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "m.model").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError, match="normalizer"):
        sentence_pieces.PrefixTable(str(tmp_path / "m.model"))


def test_query(spark, tmp_path, library):
    rng = random.Random(6)
    docs = documents(spark, [prose(rng, 50), None, "", "a  b"])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op11_sentence_pieces(spark, str(tmp_path)).collect()}
    for doc in docs.collect():
        ids = library.encode(doc["text"] or "")
        assert got[doc["doc_id"]] == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
