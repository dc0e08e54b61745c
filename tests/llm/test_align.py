"""Alignment against a walk along both token rows of each text."""

import re
from collections import Counter

import pytest
from llm_words import no_documents, odd  # noqa: F401
from pyspark.sql import functions as F

from daybook.llm.align import alignments, byte_letters
from test_token_files import odd_texts

public_tokenizers = pytest.importorskip("public_tokenizers")
from sentencepiece import SentencePieceProcessor  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def walked(texts):
    """Measures of each text, by whole texts and all pairs."""
    a_made, b_made = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a_made.encode_special_tokens = True
    letters = byte_letters()
    a_bytes = {n: bytes(letters[c] for c in t) for t, n in a_made.get_vocab(with_added_tokens=False).items()}

    def b_bytes(number):
        piece = b_made.id_to_piece(number)
        byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()

    found = []
    for text in texts:
        a = a_made.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = b_made.encode(text) if text else []
        sides = [[(x, a_bytes[x]) for x in a], [(x, b_bytes(x)) for x in b]]
        whole = (" " + (text or "")).encode()
        if not text or any(b"".join(y for _, y in s) != whole for s in sides):
            found.append(((0, 0, 0, ""), []))
            continue
        ends = []
        for side in sides:
            at, own = 0, {}
            for x, y in side:
                at += len(y)
                own[at] = x
            ends.append(own)
        groups = [([], [])]
        for at in sorted({*ends[0], *ends[1]}):
            for k in (0, 1):
                if at in ends[k]:
                    groups[-1][k].append(ends[k][at])
            if at in ends[0] and at in ends[1]:
                groups.append(([], []))
        groups.pop()
        text_of = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        found.append(((len(a), len(b), len(groups), text_of), [(x, y) for g, h in groups for x in g for y in h]))
    docs = Counter(pair for _, links in found for pair in set(links))
    most = Counter()
    for (x, _), n in docs.items():
        most[x] = max(most[x], n)
    return [
        (*sizes[:3], len(links), sum(docs[p] == most[p[0]] for p in links), sum(docs[p] for p in links), sizes[3])
        for sizes, links in found
    ]


NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


@pytest.mark.parametrize("most", [None, 0])
def test_same_as_walk(spark, most):
    """Copies, special strings, word marks, nulls, blanks, a long text without spaces; with the
    counts broadcast and with a shuffle."""
    texts = [*odd_texts(5, 150), None, "", " ", "the cat sat on the mat. " * 40, "雪é🙂" * 1500, "a­b ﬁ"]
    texts += [texts[-3]] * 30 + ["<s> </s> <unk> <0x41>", "<|endoftext|>", "an antidisestablishmentarian"] * 3
    rows = [(k, t, "x", 1, 2) for k, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, groups string, copies int, k0 int").repartition(4)
    out = alignments(frame, A, B, **({} if most is None else {"most": most}))
    assert out.columns == ["doc_id", "text", "copies", "k0", *NAMES]
    got = {r["doc_id"]: tuple(r[n] for n in NAMES) for r in out.collect()}
    assert [got[k] for k in range(len(texts))] == walked(texts)


def test_odd_documents(spark, odd):
    rows = odd.collect()
    want = walked([r["text"] for r in rows])
    got = alignments(odd, A, B, digest="sha2(groups, 256)").collect()
    key = lambda r: (r[0] is None, r[0] or 0, *[str(x) for x in r])
    mine = sorted(((r["doc_id"], r["text"], *[r[n] for n in NAMES[:6]]) for r in got), key=key)
    assert mine == sorted(((r["doc_id"], r["text"], *w[:6]) for r, w in zip(rows, want, strict=True)), key=key)
    assert {len(r["groups"]) for r in got if r["n_a"]} == {64} and {r["groups"] for r in got if not r["n_a"]} == {""}


def test_empty_table_and_no_tokens(spark, no_documents):
    assert alignments(no_documents, A, B).collect() == []
    got = alignments(spark.range(3).select("id", F.lit("").alias("text")), A, B).collect()
    assert [tuple(r[n] for n in NAMES) for r in got] == [(0, 0, 0, 0, 0, 0, "")] * 3
