"""Sentence runs against brute force on small texts, and awkward inputs."""

import random
import re
import zlib

from llm.conftest import AWKWARD, prose

from lakemart.llm import spans


def parts_by_hand(text):
    """Sentences end at a line break or at . ! ? before white space; long ones are cut before smallest pairs of words."""
    pieces, begin = [], 0
    for i, c in enumerate(text):
        blank = " \t\n\v\f\r"
        if c == "\n" or c in blank and i + 1 < len(text) and text[i + 1] not in blank or i + 1 == len(text):
            before = text[begin : i + 1].rstrip(blank)
            if c == "\n" or i + 1 == len(text) or before and before[-1] in ".!?":
                pieces.append(text[begin : i + 1])
                begin = i + 1
    out = []
    for words in (re.findall(r"[^\x20\x09-\x0D]+", p) for p in pieces):
        if not words:
            continue
        starts = [0]
        if len(words) > 20:
            crc = [zlib.crc32(w.encode()) for w in words]
            value = [(((crc[i] * 0x9E3779B1) ^ (crc[i + 1] * 0x85EBCA6B)) * 0xC2B2AE35 // 2**16) % 2**32 for i in range(len(words) - 1)]
            for i in range(1, len(words)):
                near = [j for j in range(i - 3, i + 4) if 0 <= j < len(value) and j != i]
                if i < len(value) and all(value[i] < value[j] if j < i else value[i] <= value[j] for j in near):
                    starts.append(i)
                elif i - starts[-1] >= 20:
                    starts.append(i)
        out += [words[a:b] for a, b in zip(starts, [*starts[1:], len(words)])]
    return out


def by_hand(rows):
    """The words that stay of each text, in order of ids."""
    seen, out = set(), {}
    for i, text in rows:
        parts, gone = parts_by_hand(text), set()
        for start in range(len(parts)):
            n = words = 0
            while start + n < len(parts) and (n < 2 or words < 12):
                words += len(parts[start + n])
                n += 1
            if n < 2 or words < 12:
                break
            key = tuple(w for p in parts[start : start + n] for w in p)
            if key in seen:
                gone.update(range(start, start + n))
            seen.add(key)
        out[i] = [w for j, p in enumerate(parts) if j not in gone for w in p]
    return out


def test_sentences_cover_the_text():
    random_ = random.Random(8)
    for _ in range(500):
        text = "".join(random_.choice(["a", "bb ", ". ", "! ", "\n", "  ", ".", "é", "\t"]) for _ in range(60))
        parts = spans.sentences(text)
        assert "".join(text[a:b] for a, b, _ in parts) == (text if text.split() else "")
        assert [w for p in parts for w in p[2]] == text.split()
        assert [p[2] for p in parts] == parts_by_hand(text), text
    long = " ".join(random_.choice("abcdefghij") * random_.randint(1, 3) for _ in range(900))
    assert [p[2] for p in spans.sentences(long)] == parts_by_hand(long)
    assert [len(p[2]) for p in spans.sentences(" ".join(["x"] * 100))] == [20] * 5


def test_against_brute_force(docs):
    pool = [prose(i, 15) for i in range(30)]
    random_ = random.Random(9)
    rows = [(i, "\n".join(random_.choice(pool) + " " + prose(1000 + i, 8) for _ in range(6))) for i in range(60)]
    rows += [(100 + i, " ".join(prose(2000 + i % 7, 90).replace(".", "").split()[i:])) for i in range(25)]
    found = {r["doc_id"]: r["text"].split() for r in spans.dedup(docs(*rows)).collect()}
    assert found == by_hand(rows) and any(len(found[i]) < len(t.split()) for i, t in rows)


def test_passages_pasted_mid_sentence(docs):
    """A passage of 60 words without any sentence end, after 0 to 19 words of a sentence that goes on behind it."""
    for seed in range(5):
        passage = " ".join(prose(700 + seed, 60).replace(".", "").split())
        rows = [(0, f"{prose(800, 50)}\n{passage}.")]
        for i in range(20):
            before, after = (prose(900 + 20 * seed + i + k, 30).replace(".", "").split() for k in (0, 5000))
            rows.append((1 + i, " ".join([*before[:i], passage, *after])))
        found = {r["doc_id"]: r["removed"] for r in spans.dedup(docs(*rows)).collect()}
        assert found[0] == []
        for i, text in rows[1:]:
            gone = sum(len(text[s["begin"] : s["end"]].split()) for s in found[i])
            assert gone >= 30, (seed, i, gone)
            at = text.index(passage)
            assert all(at <= s["begin"] and s["end"] <= at + len(passage) + 1 for s in found[i])


def test_a_run_of_many_documents_does_not_gather(docs):
    """Of the documents of a batch that share a run one sends its hash; repeated rows send nothing; results stay."""
    passage = prose(78, 60)
    rows = [(i, f"{prose(3000 + (i or 0), 40)}\n{passage}\n{passage}") for i in (None, *range(20, 0, -1), 7, 7)]
    df = docs(*rows).selectExpr("doc_id", "xxhash64(text) AS t", "text").coalesce(1)
    batches = df.toArrow().combine_chunks().to_batches()
    sent = [r for b in spans._rows(iter(batches)) for r in b.to_pylist()]
    hashes = [(r["a"], r["b"]) for r in sent if r["a"] is not None]
    assert len(hashes) == len(set(hashes)) and len(sent) > len(hashes)
    assert {r["doc_id"] for r in sent if r["again"]} == {None, *range(1, 21)}
    found = {(r["doc_id"], r["t"]): {tuple(p) for p in r["places"]} for r in spans.repeated_runs(df.repartition(3)).collect()}
    assert {(r["doc_id"], r["t"]): {tuple(p) for p in r["places"]} for r in spans.repeated_runs(df).collect()} == found
    kept = {r["doc_id"]: r["text"] for r in spans.dedup(docs(*rows)).collect()}
    assert [i for i, t in kept.items() if passage in t] == [None]


def test_runs_are_shuffled_once_and_not_stored(docs, monkeypatch):
    from lakemart.llm import common

    monkeypatch.setattr(common, "scratch_path", lambda *_: 1 / 0)
    rows = docs(*[(i, f"{prose(i, 80)}\n{prose(77, 60)}") for i in range(4)]).selectExpr("doc_id", "xxhash64(text) AS t", "text")
    found = spans.repeated_runs(rows)
    assert {r["doc_id"] for r in found.collect()} == {1, 2, 3}


def test_planted_passages(docs):
    passage = prose(77, 60)
    rows = [(i, f"{prose(i, 80)}\n{passage}\n{prose(500 + i, 80)}") for i in range(40)]
    found = spans.dedup(docs(*rows, extra="1 AS removed")).collect()
    assert found[0].asDict().keys() >= {"removed", "_removed"}
    for r in found:
        assert (passage in r["text"]) == (r["doc_id"] == 0)
        assert prose(r["doc_id"], 80) in r["text"] and prose(500 + r["doc_id"], 80) in r["text"]


def test_awkward_rows(docs):
    found = spans.dedup(docs(*AWKWARD)).collect()
    assert len(found) == len(AWKWARD) and spans.dedup(docs()).collect() == []
    by_id = {}
    for r in found:
        by_id.setdefault(r["doc_id"], []).append(r["text"])
    # A repeated row is one document; a copy under another id is emptied; repeats within a text go too.
    assert by_id[4] == [prose(1, 300)] * 2 and by_id[5] == [""]
    assert by_id[1] == [None] and by_id[2] == [""] and by_id[3] == [" \n\t "]
    assert 0 < len(by_id[8][0].split()) <= 60
