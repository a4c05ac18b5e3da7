import random
import re

import numpy as np
import pyarrow as pa

from terracell.llm.prefix_trie import linked
from terracell.llm.secrets import text_bytes
from terracell.llm.shingles import shingle_sets, word_hashes


def test_words_hash_alike_wherever_they_stand():
    draw = random.Random(9)
    texts = ["".join(draw.choice(["ab", "Ab", "é", "x" * draw.randrange(1, 9), " ", "\n", "  ", "\x0b"]) for _ in range(draw.choice([0, 5, 60000]))) for _ in range(9)]
    data, starts, stops = text_bytes(pa.array([*texts, None, "tail"]))
    text, found = word_hashes(data, starts, stops)
    known, at = {}, 0
    for k, t in enumerate([*texts, "", "tail"]):
        for w in re.findall("[^\x20\x09-\x0d]+", t):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), w)
            assert text[at] == k and known.setdefault(w, found[at]) == found[at]
            at += 1
    assert at == len(found) and len(set(known.values())) == len(known)


def test_sets_have_every_shingle_once():
    texts = ["a b c d a b c", "A  b\tc", "a b", "a", "", "b a", None, "a b c d a b c d"]
    text, found = shingle_sets(*text_bytes(pa.array(texts)), 3)
    sets = [set(found[text == k].tolist()) for k in range(len(texts))]
    assert [len(s) for s in sets] == [4, 1, 1, 1, 0, 1, 0, 4]
    assert sets[1] < sets[0] and sets[0] == sets[7] and sets[2] != sets[5]


def test_tree_spans_the_components_of_all_links():
    draw = np.random.default_rng(11)
    for percent in (50, 80, 90):
        for _ in range(12):
            base = [draw.integers(0, 1 << 62, int(draw.integers(1, 60))).astype(np.uint64) for _ in range(4)]
            sets = []
            for _ in range(60):
                b = base[int(draw.integers(0, 4))]
                keep = draw.random(len(b)) > draw.choice([0.02, 0.1, 0.3])
                sets.append(np.unique(np.concatenate([b[keep], draw.integers(0, 1 << 62, int(draw.integers(0, 4))).astype(np.uint64)])))
            sets = [s for s in {s.tobytes(): s for s in sets if len(s)}.values()]
            up = list(range(len(sets)))

            def find(i, up=up):
                while up[i] != i:
                    i = up[i]
                return i

            links = {(i, j) for i in range(len(sets)) for j in range(i) if 100 * (b := len(np.intersect1d(sets[i], sets[j]))) >= percent * (len(sets[i]) + len(sets[j]) - b)}
            for i, j in links:
                up[find(i)] = find(j)
            own = list(range(len(sets)))
            for i, j in linked(sets, percent):
                assert (i, j) in links or (j, i) in links
                a, b = find(i, own), find(j, own)
                assert a != b
                own[a] = b
            assert len({find(i) for i in up}) == len({find(i, own) for i in range(len(sets))})
