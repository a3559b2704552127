"""Alignments against the libraries on whole texts and plain counting."""

import hashlib
import random
from collections import Counter, defaultdict

import sentencepiece
from tokenizers import Tokenizer

from driftwell.llm import alignment
from driftwell.llm.merges import byte_symbols
from driftwell.llm.queries import tokenizer

PATHS = tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")
LETTERS = list("aàáéΣσςİßñ日本語한글кир \t\n\r\x0b\x1c\x85 　'sS1２½.,!?<|>_-´́ǅﬁ😀") + [" ", " ", " the", " of", "ing", "  ", "\n "]


def texts():
    draw = random.Random(8)
    out = ["".join(draw.choices(LETTERS, k=draw.randint(1, 60))) for _ in range(250)]
    words = ["water", "licence", "naïve", "antidisestablishment", "x9z", "Zürich", "###", "<|endoftext|>", "<s>", "</s>", "<0x41>", "日本語"]
    out += [" ".join(draw.choices(words, k=30)) for _ in range(60)]
    blob = "".join(draw.choices("ABCDEFabcdef0123456789+/", k=20_000))
    return out + ["a▁b", "", None, " ", "  ", "x ", " x", "\n", "a\n b", "same", "same", "\x00", "q\x00q", blob, "a" * 5000, "日本語" * 2000, "word " * 5000]


def brute(rows):
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    of = {s: i for i, s in enumerate(byte_symbols())}

    def bytes_a(i):
        return bytes(of[c] for c in a.id_to_token(i))

    def bytes_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    made, documents = [], Counter()
    for text in rows:
        x = a.encode(" " + text, add_special_tokens=False).ids if text else []
        y = b.encode(text) if text else []
        own = (" " + text).encode() if text else b""
        if b"".join(map(bytes_a, x)) != own or b"".join(map(bytes_b, y)) != own:
            x, y = [], []
        groups, i, j, left, right, gap = [], 0, 0, [], [], 0
        while i < len(x) or j < len(y):
            if gap <= 0:
                gap += len(bytes_a(x[i]))
                left.append(x[i])
                i += 1
            else:
                gap -= len(bytes_b(y[j]))
                right.append(y[j])
                j += 1
            if gap == 0:
                groups.append((left, right))
                left, right = [], []
        links = Counter()
        for left, right in groups:
            for p, n in Counter(left).items():
                for q, m in Counter(right).items():
                    links[p, q] += n * m
        documents.update(set(links))
        made.append((x, y, groups, links))
    best = defaultdict(int)
    for (p, _), n in documents.items():
        best[p] = max(best[p], n)
    out = []
    for x, y, groups, links in made:
        shown = ";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in groups)
        top = sum(n for k, n in links.items() if documents[k] == best[k[0]])
        total = sum(n * documents[k] for k, n in links.items())
        out.append((len(x), len(y), len(groups), sum(links.values()), top, total, hashlib.sha256(shown.encode()).hexdigest() if x else ""))
    return out


def check(spark, rows):
    frame = spark.createDataFrame([(i, t, 1, "g") for i, t in enumerate(rows)], "doc_id long, text string, row int, groups string").repartition(6)
    got = {r.doc_id: tuple(r)[1:] for r in alignment.weighed_alignments(frame, *PATHS, kept=["doc_id"]).collect()}
    wanted = brute(rows)
    for i, want in enumerate(wanted):
        assert got[i] == want, repr(rows[i])[:200]
    assert len(got) == len(rows)


def test_equal_to_whole_texts(spark):
    check(spark, texts())


def test_rare_pairs_are_joined(spark, monkeypatch):
    monkeypatch.setattr(alignment, "COMMON", 5)
    monkeypatch.setattr(alignment, "KNOWN_UNITS", 50)
    monkeypatch.setattr(alignment, "PAIRS_AT_ONCE", 7)
    check(spark, texts()[:120])


def test_kept_columns_and_empty(spark):
    frame = spark.createDataFrame([(None, "a b", "n"), (None, "a b", "n")], "n_a long, text string, row string")
    got = alignment.weighed_alignments(frame, *PATHS, kept=["row"])
    assert got.columns == ["row", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert [(r.row, r.n_a, r.n_best, r.count_sum) for r in got.collect()] == [("n", 2, 2, 4)] * 2
    assert alignment.weighed_alignments(frame.limit(0), *PATHS).count() == 0
