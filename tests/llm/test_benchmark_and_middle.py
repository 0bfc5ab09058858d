"""Decontamination, the filter audit and fill-in-the-middle, against brute force."""

import hashlib
import random
import re
from collections import Counter
from itertools import permutations

import pytest

from lotledger.llm import decontam, filteraudit, fillmiddle

DOCS = "doc_id long, text string, source string, n_words int, raw string, spans int, items int, part string, bits int, hash int"


def docs_frame(spark, rows):
    """Rows (doc_id, text, source), with columns whose names the operators use too."""
    return spark.createDataFrame([(*r, 1, "x", 2, 3, "y", 4, 5) for r in rows], DOCS)


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def hits_by_force(text, items, window):
    words, hit, found = item_words(text), set(), set()
    for item, body in items:
        of = item_words(body)
        size = min(window, len(of))
        grams = {tuple(of[k:k + size]) for k in range(len(of) - size + 1)} if of else set()
        for k in range(len(words) - size + 1):
            if size and tuple(words[k:k + size]) in grams:
                hit |= set(range(k, k + size))
                found.add("" if item is None else str(item))
    return len(words), hit, found


def random_items(rng, n, most):
    return [(k, " ".join(rng.choice("abcde") for _ in range(rng.randint(0, most)))) for k in range(n)]


def random_text(rng, items, pieces):
    out = []
    for _ in range(pieces):
        of = (rng.choice(items)[1] or "").split()
        x = rng.randrange(len(of) + 1)
        out += of[x:x + rng.randint(1, 14)] + [rng.choice("abcdexyz") for _ in range(rng.randrange(4))]
    return rng.choice([" ", ", ", "\n-"]).join(out)


@pytest.mark.parametrize("window, block_bytes", [(10, 1 << 20), (4, 1 << 20), (4, 150)])
def test_hits(spark, window, block_bytes):
    rng = random.Random(window)
    items = random_items(rng, 30, 25) + [(None, "É1 zz É1"), (3, "zz ÉÉ q"), (100, None), (101, " .,"), (102, "One")]
    items += items[:3]
    docs = [(k, random_text(rng, items, 12), "s") for k in range(60)]
    docs += [(100, None, None), (101, "", None), (102, "?!", None), (None, items[5][1], None), (None, items[5][1], None), (1, docs[1][1], "s"),
             (103, "ONE\x00é1 ZZ é1 zz ÉÉ Q é1 É1 zz É1", None), (104, "x " * 70_000 + items[4][1] + "y" * 600_000 + " " + items[4][1], None)]
    got = decontam.digests(decontam.matched(docs_frame(spark, docs), spark.createDataFrame(
        [(*i, "d", 7) for i in items], "item_id long, text string, doc_id string, words int"), window, block_bytes=block_bytes)).collect()
    want = []
    for doc_id, text, _ in docs:
        n, hit, found = hits_by_force(text, items, window)
        want.append((doc_id, n, len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert sum(r.contaminated for r in got) > 20


def test_long_items_in_pieces_keep_every_window(spark, monkeypatch):
    rng = random.Random(1)
    item = [f"w{rng.randrange(30)}" for _ in range(500)]
    frame = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    pieces = [bytes(r.words).decode().split(" ") for r in decontam.item_pieces(frame, 10, most=37).collect()]
    windows = lambda words: {tuple(words[k:k + 10]) for k in range(len(words) - 9)}
    assert max(map(len, pieces)) == 37 and min(map(len, pieces)) >= 10
    assert set.union(*map(windows, pieces)) == windows(item)


def test_long_texts_are_streamed_in_parts(monkeypatch):
    rng = random.Random(2)
    raw = bytes(rng.choice(b"ab .,AB\xc3\xa9") for _ in range(5000)) + b"q" * 300 + b" end"
    whole = decontam.WORD.findall(raw.lower())
    for size in (1, 7, 64):
        monkeypatch.setattr(decontam, "STRETCH", size)
        assert decontam.words(raw) == whole
        spans = [[0, 1], [5, 9], [len(whole) - 2, len(whole)]]
        assert [raw[x:y].lower() for x, y in decontam.places(raw, spans)][0] == whole[0]
        assert [decontam.WORD.findall(raw[x:y].lower()) for x, y in decontam.places(raw, spans)] == [whole[a:b] for a, b in spans]


def test_automaton_tracks_the_longest_match():
    rng = random.Random(3)
    for _ in range(40):
        pieces = [(str(k), b" ".join(bytes([rng.choice(b"abc")]) for _ in range(rng.randint(1, 12)))) for k in range(6)]
        flat = decontam.automaton(pieces, 4)
        matcher = decontam.Matcher(flat)
        strings = {tuple(x[a:b]) for _, p in pieces for x in [p.split()] for a in range(len(x)) for b in range(a + 1, len(x) + 1)}
        text = [bytes([rng.choice(b"abcd")]) for _ in range(60)]
        state = length = 0
        for end, word in enumerate(map(matcher.ids.get, text), 1):
            if word is None:
                state = length = 0
            else:
                while (target := matcher.step.get(state * matcher.width + word)) is None:
                    state = matcher.link[state]
                    length = matcher.length[state]
                state, length = target, length + 1
            assert length == max((k for k in range(end + 1) if k == 0 or tuple(text[end - k:end]) in strings))


def test_cleaning(spark):
    item = "one two three four five six"
    docs = [(1, f"Start here. {item.upper()}, more words that stay in it until the end of it, yes.", "s"), (2, f"a {item}.", "s"),
            (3, "nothing", "s"), (4, None, "s"), (5, "é one two é three, " * 3, "s")]
    items = spark.createDataFrame([(1, item), (2, "three four five six one two"), (3, "é three")], "item_id long, text string")
    got = {r.doc_id: r for r in decontam.cleaned(docs_frame(spark, docs), items, window=4, min_words=4).collect()}
    assert got[1].text == "Start here. , more words that stay in it until the end of it, yes." and got[1].n_removed == 6 and not got[1].dropped
    assert got[2].dropped and got[2].text is None and got[2].n_removed == 7
    assert [(got[k].text, got[k].n_removed, got[k].dropped) for k in (3, 4)] == [("nothing", 0, False), ("", 0, False)]
    assert got[5].text == "é one two é three, " * 3 and got[5].n_removed == 0  # hits of two words are short
    assert decontam.cleaned(docs_frame(spark, docs[4:]), items, window=4, min_words=2).first().text == "é one two , " * 3


def test_empty_tables(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    got = decontam.digests(decontam.matched(docs_frame(spark, [(1, "a b", None)]), items)).collect()
    assert [tuple(r) for r in got] == [(1, 2, 0, 0, hashlib.sha256(b"").hexdigest(), False)]
    assert decontam.digests(decontam.matched(docs_frame(spark, []), items)).count() == 0
    assert filteraudit.audited(docs_frame(spark, []), spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0
    assert fillmiddle.digests(fillmiddle.transformed(docs_frame(spark, []))).count() == 0


def failures(docs):
    out = []
    for doc_id, text, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
                  "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), "D": bool(re.search("[#$%&*|]", text)),
                  "E": any(i is not None and doc_id is not None and i < doc_id and (x or "") == text for i, x, _ in docs)}
        out.append((doc_id, source or "", {k for k, v in failed.items() if v}))
    return out


def audited_by_force(docs, labels):
    out = {}
    marked = failures(docs)
    good, toxic = ({i for i, *v in labels if v[k] == 1 and i is not None} for k in (0, 1))
    for part in {p for _, p, _ in marked}:
        rows = [(i, f) for i, p, f in marked if p == part]
        for order in permutations("ABCDE"):
            left = rows
            for step, x in enumerate(order, 1):
                gone = [r for r in left if x in r[1]]
                left = [r for r in left if x not in r[1]]
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(x in f for _, f in rows) - len(gone), sum(f == {x} for _, f in rows),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
        total = Counter()
        for (p, order, step), v in out.items():
            total[order[step - 1]] += v[1] * (p == part)
        for (p, order, step), v in out.items():
            if p == part:
                v.append(total[order[step - 1]])
    return out


def test_audit(spark):
    rng = random.Random(5)
    long = " ".join(f"w{k}" for k in range(60))
    texts = [None, "", "a", "A B C", "# x", long, long + " #", long.upper(), "w " * 80, long + " ", long + "\n" + long, long + " ÉÉ" * 3, "W" * 300_000]
    docs = [(rng.randrange(40), rng.choice(texts), rng.choice(["p", "q", None, ""])) for _ in range(120)]
    docs += docs[:10] + [(None, "a", "p"), (None, long, "z"), (7, "lone text", "z"), (7, "lone text", "z")]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1])) for k in range(0, 40, 2)] + [(4, 1, None), (4, 1, 1), (None, 1, 1)]
    got = filteraudit.audited(docs_frame(spark, docs).repartition(4), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {(r.part, r.filter_order, r.step): [r[n] for n in names] for r in got} == audited_by_force(docs, labels)
    assert len(got) == 600 * len({s or "" for _, _, s in docs})


def middle_by_force(doc_id, text, rate, spm):
    text = text or ""
    tokens = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in range(0, 32, 8))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= rate:
        return doc_id, len(tokens), "plain", None, None, text
    x, y = sorted((h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)))
    prefix, middle, suffix = ("".join(t) for t in (tokens[:x], tokens[x:y], tokens[y:]))
    if h4 % 100 < spm:
        return doc_id, len(tokens), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, len(tokens), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("rate, spm", [(50, 80), (100, 50)])
def test_fill_middle(spark, rate, spm):
    rng = random.Random(rate)
    shared = "".join(rng.choice("ab é \n\t𝄞 ") for _ in range(3000))
    rows = [(k, "".join(rng.choice("ab  é\n𝄞.") for _ in range(rng.randint(1, 400))) + rng.choice(["", shared, " "]), "s") for k in range(150)]
    rows += [(500 + k, x, "s") for k, x in enumerate(
        [None, "", " ", "a", " ", " a ", "a <P> b", "<M>", "< P>", "x" * 200_000, " " * 200_000, "é " * 150_000 + "end", shared * 60])]
    rows += [(None, "no id here", None), rows[3], rows[3]]
    got = fillmiddle.transformed(docs_frame(spark, rows), rate=rate, spm=spm)
    want = [middle_by_force(i, x, rate, spm) for i, x, _ in rows]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    texts = Counter(hashlib.sha256((x or "").encode()).hexdigest() for _, x, _ in rows)
    assert Counter(r.restored_sha256 for r in fillmiddle.digests(got).collect()) == texts


def test_chunks_are_those_of_the_content():
    rng = random.Random(9)
    shared = bytes(rng.randrange(97, 123) for _ in range(40_000))
    chunks = fillmiddle.Chunks()
    first = fillmiddle.Text(b"some start " + shared + b" x", chunks)
    read = chunks.read
    second = fillmiddle.Text(b"another, longer, start of it " + shared + b" y", chunks)
    assert len(second.ends) > 40 and chunks.read - read <= 4  # only what differs is read again
    assert [b"".join((t.raw[x:y] for x, y in zip(t.starts, t.ends))) for t in (first, second)] == [first.raw, second.raw]
    few = fillmiddle.Chunks(most=2000)
    assert fillmiddle.Text(shared, few).n == 1 and few.held <= 2000 + fillmiddle.LONGEST
