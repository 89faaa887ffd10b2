"""Packing, SentencePiece round trip and token counts against the libraries."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lakeforge.llm import packing, piece_encoding, token_counts
from lakeforge.llm.common import documents, vocabulary
from lakeforge.llm.piece_model import CharacterMap, PieceModel, fields, load

SF = "/root/testdata/sf0.001"
ODD = ["", None, "a", "  two  spaces ", "tab\tand\x1cfs\x85nel em", "a<|endoftext|>b <s>", "é é ﬁ ①", "漢字😀" * 30,
       "▁mark ▁▁", "\x00nul", "x" * 5000, "word " * 3000, "a<|startoftext|> it's 12,5"]


@pytest.fixture
def odd(spark):
    rows = [(i, t, "en") for i, t in enumerate(ODD)] + [(2, "a", "de"), (2, "again", "de"), (None, "no id", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, length string")


def encoded(tk, text):
    return [*tk.encode(text or "", add_special_tokens=False).ids, 1]


def check_packing(out, texts, capacity=4096):
    tk = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    by_doc = {}
    for r in out:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for doc, text in texts.items():
        ids, rows = encoded(tk, text), sorted(by_doc[doc], key=lambda r: r["piece"])
        assert [(r["piece"], r["start"]) for r in rows] == [(i, s) for i, s in enumerate(range(0, len(ids), capacity))]
        for r in rows:
            part = ids[r["start"] : r["start"] + capacity]
            assert r["length"] == len(part) and r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
    check_layout([(r["sequence_id"], r["offset"], r["length"]) for r in out], capacity)


def check_layout(places, capacity):
    by_sequence = {}
    for s, o, n in places:
        by_sequence.setdefault(s, []).append((o, n))
    for parts in by_sequence.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    return len(by_sequence)


def test_packing_whole_table(spark):
    docs = documents(spark, SF)
    check_packing(packing.query(spark, SF).collect(), {r["doc_id"]: r["text"] for r in docs.collect()})


def test_packing_odd_texts_repeated_and_null_ids(spark, odd):
    out = packing.pack_documents(odd, with_ids=True).collect()
    tk = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    want = Counter()
    for r in odd.collect():
        ids = encoded(tk, r["text"])
        want.update((r["doc_id"], s, tuple(ids[s : s + 4096])) for s in range(0, len(ids), 4096))
    assert Counter((r["doc_id"], r["start"], tuple(r["ids"])) for r in out) == want
    check_layout([(r["sequence_id"], r["offset"], r["length"]) for r in out], 4096)


def test_packing_empty_table(spark, odd):
    assert packing.pack_documents(odd.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_plan_places_every_piece_once_and_tightly(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.choice([12, 100, 4096]))
    sizes = rng.integers(1, capacity + 1, int(rng.integers(1, 3000)))
    if seed % 2:
        sizes = np.minimum(sizes, rng.geometric(4 / capacity, len(sizes)))
    histogram = Counter(sizes.tolist())
    plan, sequences = packing.plan_packing(dict(histogram), capacity)
    places, numbers = [], Counter()
    for length, first, n, seq, per, offset in plan:
        assert first == numbers[length]
        numbers[length] += n
        places += [(seq + k // per, offset + k % per * length, length) for k in range(n)]
    assert numbers == histogram
    assert check_layout(places, capacity) == sequences
    # No better than the volume allows, and no worse than first fit decreasing by more than 2 %.
    bins = []
    for s in sorted(sizes.tolist(), reverse=True):
        i = next((i for i, room in enumerate(bins) if room >= s), None)
        if i is None:
            bins.append(capacity - s)
        else:
            bins[i] -= s
    assert -(-sizes.sum() // capacity) <= sequences <= 1.02 * len(bins) + 1


def test_sentencepiece_whole_table(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    texts = {r["doc_id"]: r["text"] or "" for r in documents(spark, SF).collect()}
    out = piece_encoding.query(spark, SF).collect()
    assert len(out) == len(texts)
    for r in out:
        ids = sp.encode(texts[r["doc_id"]], add_eos=True)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(sp.decode(ids).encode()).hexdigest()
        assert r["covered_bytes"] == len(texts[r["doc_id"]].encode())


def test_spans_are_the_pieces_bytes_and_decode_gives_the_text(spark, odd):
    coded = piece_encoding.encode_pieces(odd)
    texts = Counter((r["doc_id"], r["text"] or "") for r in odd.collect())
    found = Counter()
    for r in coded.collect():
        model = load("piece_bpe_32k.model")
        matches = [t for i, t in texts if i == r["doc_id"] and model.library.encode(t, add_eos=True) == r["ids"]]
        data = matches[0].encode()
        found[r["doc_id"], matches[0]] += 1
        assert r["ends"][-1] == len(data) and r["begins"][1:] == r["ends"][:-1]
        for i, b, e in zip(r["ids"], r["begins"], r["ends"]):
            piece = model.library.id_to_piece(i)
            if not piece.startswith("<") and "▁" not in matches[0] and b:
                assert data[b:e].decode() == piece.replace("▁", " ")
    assert found == texts
    assert Counter(r["text"] for r in piece_encoding.decode_pieces(coded).collect()) == Counter(t.replace("▁", " ") for _, t in texts.elements())
    assert piece_encoding.round_trip(odd.limit(0)).count() == 0


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
@pytest.mark.parametrize("squeeze", [False, True])
def test_character_map_alignment(rule, squeeze):
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=squeeze)
    model = PieceModel(vocabulary("piece_bpe_32k.model"))
    model.map = CharacterMap(fields(fields(library.serialized_model_proto())[3][0]).get(2, [b""])[-1])
    model.squeeze = squeeze
    rng = np.random.default_rng(7)
    alphabet = list("ab  c▁é漢😀\n\t字1ﬁ①Ａé　…ǅ½")
    for _ in range(400):
        text = "".join(rng.choice(alphabet, rng.integers(0, 20)))
        normal, origin = model.normalise(text)
        assert normal.decode() == library.Normalize(text)
        assert len(origin) == len(normal) + 1 and (np.diff(origin) >= 0).all() and origin[-1] <= len(text.encode())


def test_fast_and_general_spans_agree():
    model = PieceModel(vocabulary("piece_bpe_32k.model"))
    for text in (t for t in ODD if t and "▁" not in t):
        ids = model.library.encode(text)
        model.plain = True
        fast = model.spans(text, ids)
        model.plain = False
        assert all((a == b).all() for a, b in zip(fast, model.spans(text, ids)))


def counts(df, **kw):
    return Counter((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts.token_counts(df, **kw).collect())


def brute_counts(df):
    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    rows = [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]
    return Counter((i, len(t.encode()), n := len(sp.encode(t)), n > 4096) for i, t in rows)


def test_token_counts_whole_table(spark):
    docs = documents(spark, SF)
    assert counts(docs) == brute_counts(docs)


def test_token_counts_small_chunks_resynchronise(spark):
    docs = documents(spark, SF)
    assert counts(docs, chunk=96, overlap=32) == brute_counts(docs)


def test_token_counts_odd_texts_and_widening(spark, odd):
    """Runs of one character never share a boundary until the chunk holds them whole."""
    assert counts(odd, chunk=64, overlap=16) == brute_counts(odd)
    assert counts(odd.limit(0)) == Counter()


def test_chunk_rules_equal_the_tokenizer():
    encoder = packing.PieceEncoder(vocabulary("word_bpe_49k.json"), limit=2000)
    rng = np.random.default_rng(3)
    alphabet = [chr(c) for c in range(0x20, 0x250)] + list("'''sStTrReEvVmMlLdD  ́ÅÉé①Ⅷ ­\x7f\x01漢")
    texts = ["".join(rng.choice(alphabet, rng.integers(1, 12))) for _ in range(4000)]
    for begin in range(0, len(texts), 400):
        part = texts[begin : begin + 400]
        for text, ids in zip(part, encoder.encode(part)):
            assert encoder.tokenizer.encode(text, add_special_tokens=False).ids == ids.tolist(), text


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_packing_ids_with_other_tokenizers(name):
    """A file with other rules than the known ones is encoded by its library."""
    from tokenizers import Tokenizer

    texts = ["Hello World, it's ME\n\n and 12 déjà-vu 漢字", "", " a  B\tc", "x" * 900, "I I I"]
    library = Tokenizer.from_file(vocabulary(name))
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids.tolist() for ids in packing.PieceEncoder(vocabulary(name)).encode(texts)] == want
