import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from odd import DOCS, empty_documents, odd_documents
from tidemill.llm import spelling as S

SETTINGS = S.Settings(every=7, block=40, queries=60, leaf=3, known=50)


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, grown = sorted((a, b), key=len)
    return any(grown[:i] + grown[i + 1 :] == short for i in range(len(grown)))


def by_hand(docs, settings):
    found = Counter()
    for doc_id, text in docs:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % settings.every == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            found[word] += 1
    n = {w: c for w, c in found.items() if len(w) >= settings.letters and c >= settings.least}
    near = {w: [o for o in n if one_edit(w, o)] for w in n}
    best = {w: min(near[w], key=lambda o: (-n[o], o)) if near[w] else None for w in n}
    form = {w: b if b and n[b] >= settings.ratio * n[w] else None for w, b in best.items()}

    def root(word):
        return root(form[word]) if form[word] else word

    return sorted((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n)


def got(frame, settings):
    columns = "word", "form", "root", "n", "n_near", "form_n"
    return sorted(tuple(row[c] for c in columns) for row in S.variants(frame, settings).collect())


def misspelt(seed, count):
    """Texts of few words, many of them with an edit, in two alphabets and cases."""
    rng = random.Random(seed)
    words = ["harbour", "Harbor", "orchard", "élèveß", "ÉLÈVES", "candle", "stonewall", "aaaaa", "aaaaaa", "over×it", "ab", "x" * 70]
    docs = []
    for n in range(count):
        text = []
        for _ in range(rng.randrange(1, 40)):
            word = rng.choice(words)
            if rng.random() < 0.4:
                at = rng.randrange(len(word))
                word = rng.choice([word[:at] + word[at + 1 :], word[:at] + rng.choice("aeé") + word[at:], word[:at] + rng.choice("oÿ") + word[at + 1 :]])
            text.append(word)
        docs.append((n, rng.choice([" ", ", ", "中", "́", "-ĉ"]).join(text)))
    return docs


@pytest.mark.parametrize("settings", [SETTINGS, S.Settings(every=5, least=1), S.Settings(every=5, least=1, key_words=8, leaf=2)])
def test_forms_and_roots_equal_those_by_hand(spark, settings):
    docs = misspelt(1, 150)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    found = got(frame, settings)
    assert found == by_hand(docs, settings)
    assert any(form and root != form for _, form, root, *_ in found)


def test_ways_of_many_steps_are_followed(spark):
    """A chain of words, each twice as frequent as the one before: the last is the root of all."""
    chain = ["abcdefgh"[:i] + "z" * (8 - i) for i in range(9)]
    docs = [(n, word) for i, word in enumerate(chain) for n in range(3 * 2**i)]
    settings = S.Settings(every=1 << 40)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = {row[0]: row for row in got(frame, settings)}
    assert {row[2] for row in found.values()} == {chain[-1]}
    assert sorted(found.values()) == by_hand(docs, settings)


def test_a_trie_finds_each_pair_once():
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("aeihé") for _ in range(rng.randrange(5, 8))) for _ in range(600)} | {"e" * k for k in range(45, 60)})
    settings = S.Settings(leaf=4)
    trie = S.Trie(words, np.arange(len(words)), 3, settings)
    trie_words = [text.decode("latin-1") for text in trie.spelled.text]
    # All words under one key: counts of the key's groups must agree within the budget too.
    asked, none = S.Spelled(words, 3), np.zeros(len(words), bool)
    one, other = trie.near(asked, none, none)
    pairs = list(zip([words[i] for i in one], [trie_words[i] for i in other]))
    keys = lambda word: tuple(word.count(S.GROUPS[i]) for i in range(3))
    expected = {(a, b) for a in words for b in words if one_edit(a, b)}
    assert len(pairs) == len(set(pairs)) and {p for p in pairs if keys(p[0]) == keys(p[1])} == {p for p in expected if keys(p[0]) == keys(p[1])}


def test_more_words_make_longer_keys():
    found = [S.key_groups(words, S.Settings()) for words in (0, 1, 2_000_000, 2_000_001, 8_000_000, 32_000_001, 10**30)]
    assert found == [3, 3, 3, 4, 4, 6, len(S.GROUPS) - 1]


def test_checksums_carry_on():
    data = np.frombuffer(b"abc" + b"q" * 100 + b"", np.uint8)
    start, end = np.array([0, 1, 3, 3]), np.array([3, 1, 103, 51])
    before = np.array([zlib.crc32(b"7:"), zlib.crc32(b":"), zlib.crc32(b"12:"), 0], np.uint32)
    found = S.checksums(data, start, end, before).tolist()
    assert found == [zlib.crc32(b"7:abc"), zlib.crc32(b":"), zlib.crc32(b"12:" + b"q" * 100), zlib.crc32(b"q" * 48)]


def test_odd_documents(spark):
    docs = [tuple(row[:2]) for row in odd_documents(spark).select("doc_id", "text").collect()]
    settings = S.Settings(every=3, least=2)
    assert got(odd_documents(spark), settings) == by_hand(docs, settings)
    long_word = [(1, "ab" * 200_000), (2, "ab" * 200_000 + "a"), (3, "ab" * 200_000), (4, "é" * 49), (5, "é" * 50)]
    settings = S.Settings(every=1 << 40, least=1)
    assert got(spark.createDataFrame(long_word, "doc_id long, text string"), settings) == by_hand(long_word, settings)


def test_without_words_there_are_no_rows(spark):
    assert got(empty_documents(spark), SETTINGS) == []
    assert got(spark.createDataFrame([(1, None, "en", "a", 1), (2, "1 2 ...", "en", "a", 1)], DOCS), SETTINGS) == []
