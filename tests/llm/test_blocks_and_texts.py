"""Kernels without Spark: words, quality measures, suffix automaton, Simple-8b, Pfair frames, archives, licences."""

import random
import re
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ticketloom.llm import archives, licences, mixing, neardup, quality, shards, simple8b, token_files
from ticketloom.llm.blocks import Words, blocks, utf8
from ticketloom.llm.decontaminate import Automaton, merged, normalised_words
from ticketloom.llm.licence_texts import TEMPLATES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = ["", " ", "\n", "a", "a  b\tc\n\nd", "é ü\x00x 　y", "x" * 5000, "one two three four five " * 40, "#*$ %&| <>\n#\n#", "\n\nab\nab\ncd\nab"]


def test_words_of_odd_texts():
    words = Words(*utf8(pa.array([*ODD, None])))
    raw = words.raw.tobytes()
    found = [raw[a:b].decode() for a, b in zip(words.starts, words.ends)]
    want = [w for t in ODD for w in WORD.findall(t)]
    assert found == want
    assert words.counts.tolist() == [len(WORD.findall(t)) for t in [*ODD, ""]]
    by_hash = {}
    for w, h in zip(found, words.hashes.tolist()):
        assert by_hash.setdefault(w, h) == h
    assert len(set(by_hash.values())) == len(by_hash)


def test_blocks_keep_every_row():
    texts = ["a" * n for n in (0, 5, 100, 0, 3, 50, 50)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["t"])
    for limit in (1, 10, 60, 1000):
        got = [x for b in blocks([batch, batch.slice(0, 0)], "t", limit) for x in b.column("t").to_pylist()]
        assert got == texts


def measures(text):
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
    }


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab \n#é", max_size=60), max_size=6))
def test_quality_measures(texts):
    block = utf8(pa.array(texts, pa.string()))
    got = {}
    for make in set(quality.MEASURES.values()):
        got |= make(block)
    for k, text in enumerate(texts):
        assert {m: int(v[k]) for m, v in got.items()} == measures(text)


def brute_hits(items, document, window):
    """Hit word positions and items, by comparing every window with every place."""
    hit, found = set(), set()
    for name, words in items:
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            for j in range(len(document) - n + 1):
                if document[j : j + n] == words[i : i + n]:
                    hit |= set(range(j, j + n))
                    found.add(name)
    return hit, found


@pytest.mark.parametrize("seed", range(40))
def test_automaton_against_brute_force(seed):
    r = random.Random(seed)
    letters = "abc"[: r.randint(1, 3)]
    window = r.choice([1, 2, 3, 4])
    items = [(f"i{k}", [r.choice(letters) for _ in range(r.randint(0, 8))]) for k in range(r.randint(0, 6))]
    texts = [" ".join(r.choice(letters + "z") for _ in range(r.randint(0, 25))) for _ in range(8)]
    item_words = normalised_words(pa.array([" ".join(w) for _, w in items], pa.string()))
    hashes = [item_words.hashes[a:b] for a, b in zip(item_words.bounds[:-1], item_words.bounds[1:])]
    automaton = Automaton.build([(n, h) for (n, _), h in zip(items, hashes)], window)
    for text, (hits, found, longest) in zip(texts, automaton.search(normalised_words(pa.array(texts, pa.string())))):
        words = text.split()
        want, names = brute_hits(items, words, window)
        assert {k for a, b in merged(hits) for k in range(a, b)} == want
        assert found == names
        runs = [n for _, w in items for i in range(len(w)) for n in range(1, len(w) - i + 1)
                if any(words[j : j + n] == w[i : i + n] for j in range(len(words)))]
        if automaton.shortest <= max(runs, default=0):
            assert longest == max(runs, default=0)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=1500), st.integers(1, 600))
def test_simple8b_round_trip(values, block):
    values = np.array(values, np.uint64)
    words, offsets = simple8b.encode(values, block)
    assert (simple8b.decode(words, offsets, len(values), block) == values).all()
    assert len(offsets) == -(-len(values) // block)


def test_simple8b_packs():
    words, _ = simple8b.encode(np.full(512, 30_000, np.uint64))
    assert len(words) == 128  # four values of fifteen bits to a word
    words, _ = simple8b.encode(np.zeros(480, np.uint64))
    assert len(words) == 4


@pytest.mark.parametrize("seed", range(25))
def test_pfair_frame_deviates_by_less_than_a_block(seed):
    r = random.Random(seed)
    slots = r.choice([20, 99, 400])
    places = mixing.quantised({f"s{k}": r.random() ** 3 + 1e-6 for k in range(r.randint(1, 12))} | {None: 0.1}, slots)
    frame = mixing.frame(places)
    assert sum(places.values()) == len(frame) == slots
    for source, n in places.items():
        assert [j for s, j in frame if s == source] == list(range(1, n + 1))
    assert mixing.lag([s for s, _ in frame] * 2, {s: Fraction(n, slots) for s, n in places.items()}) < 1


def test_weights_are_checked():
    assert mixing.quantised({}) == {}
    with pytest.raises(ValueError):
        mixing.quantised({"a": 0.0})
    with pytest.raises(ValueError):
        mixing.quantised({str(k): 1.0 for k in range(11)}, 10)


def test_fisher_yates_is_a_uniform_permutation():
    assert shards.fisher_yates(0, 1).tolist() == [] and shards.fisher_yates(1, 1).tolist() == [0]
    seen = {}
    for seed in range(6000):
        p = tuple(shards.fisher_yates(3, seed).tolist())
        assert sorted(p) == [0, 1, 2]
        seen[p] = seen.get(p, 0) + 1
    assert len(seen) == 6 and min(seen.values()) > 850 and max(seen.values()) < 1150


@pytest.mark.parametrize("seed", range(4))
def test_bagminhash_is_unbiased(seed):
    r = np.random.default_rng(seed)
    n = 300
    a = r.integers(1, 60, n) * (r.random(n) < 0.7)
    b = np.where(r.random(n) < 0.6, a, r.integers(0, 60, n))
    ids = r.integers(0, 2**63, n).astype(np.uint64)
    text = np.concatenate([np.zeros((a > 0).sum(), int), np.full((b > 0).sum(), 2)])
    sig = neardup.signatures(text, np.concatenate([ids[a > 0], ids[b > 0]]), np.concatenate([a[a > 0], b[b > 0]]), 3, 4096)
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((sig[0] == sig[2]).mean() - true) < 4 * (true * (1 - true) / 4096) ** 0.5
    assert not sig[1].any()


def test_signature_does_not_depend_on_the_block():
    r = np.random.default_rng(5)
    ids, count = r.integers(0, 2**63, 50).astype(np.uint64), r.integers(1, 9, 50)
    alone = neardup.signatures(np.zeros(50, int), ids, count, 1, 64)
    order = r.permutation(50)
    beside = neardup.signatures(np.concatenate([np.full(50, 1), np.zeros(9, int)]), np.concatenate([ids[order], ids[:9]]),
                                np.concatenate([count[order], count[:9]]), 2, 64)
    assert (alone[0] == beside[1]).all()


def test_arc_versions_and_damage():
    for version in (1, 2):
        body = b"HTTP/1.1 200 OK\r\nX-Page-Id: 5\r\n\r\nline\nWARC/1.1 2 3"
        url = "http://a b/c" if version == 1 else "http://a/c"
        content = archives.version_block(version, "20240101000000", "x.arc")
        content += archives.arc_header(version, url, "1.2.3.4", "2001", "text/html", len(body)) + body + b"\n"
        content += archives.arc_header(version, "dns:a", "1.2.3.4", "20010203040506", "text/dns", 0) + b"\n\n"
        records = list(archives.read_arc(content))
        assert [r.url for r in records] == ["filedesc://x.arc", url, "dns:a"]
        assert records[1].block == body and records[1].version == version and records[2].block == b""
        with pytest.raises(ValueError):
            list(archives.read_arc(content[: content.index(b"X-Page")]))
    assert archives.warc_date("2001") == "2001-01-01T00:00:00Z"
    assert archives.warc_date("20010203040506") == "2001-02-03T04:05:06Z"
    assert list(archives.read_arc(b"")) == []


def test_warc_records_round_trip():
    block = b"\r\n\r\nWARC/1.1\r\n\xff"
    content = archives.warc_record([("WARC-Type", "resource"), ("X", None)], block) + archives.warc_record([("WARC-Type", "warcinfo")], b"")
    (a, x), (b, y) = archives.read_warc(content)
    assert (a["WARC-Type"], x, b["WARC-Type"], y) == ("resource", block, "warcinfo", b"")
    with pytest.raises(ValueError):
        list(archives.read_warc(content[:-1]))


def brute_licences(text, threshold):
    def bigrams(x):
        w = re.findall(r"[a-z0-9\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), x))
        return {tuple(w[i : i + 2]) for i in range(len(w) - 1)}

    lines, paragraph, parts = text.split("\n"), [], [text]
    for line in [*lines, ""]:
        parts.append(line)
        if re.search(r"[A-Za-z0-9\u0080-\U0010ffff]", line):
            paragraph.append(line)
        else:
            parts.append("\n".join(paragraph))
            paragraph = []
    out = {}
    for name, body in TEMPLATES:
        t = bigrams(body)
        for p in map(bigrams, parts):
            if p and 2 * len(p & t) >= threshold * (len(p) + len(t)):
                out[name] = max(out.get(name, 0), 2 * len(p & t) / (len(p) + len(t)))
    return out


def test_licences_against_brute_force(spark):
    r = random.Random(3)
    bodies = dict(TEMPLATES)
    texts = ["", None, " \n", "x", "Released under the MIT License.", "prose here\nReleased under the MIT License.\nmore prose",
             "RELEASED under, the\nMIT License", "a b c\n\n" + bodies["ISC"].replace(". ", ".\n") + "\n\nd e f", bodies["BSD-3-Clause"],
             bodies["Apache-2.0-notice"] + "\n" + "filler words " * 400, "Licensed under CC BY-NC 4.0.\n" * 3]
    for _ in range(40):
        words = bodies[r.choice(list(bodies))].split()
        for _ in range(r.randint(0, 6)):
            words[r.randrange(len(words))] = r.choice(["foo", "\n", "bar\n\n", ""])
        texts.append(" ".join(words))
    frame = spark.createDataFrame([(k, t, 1.0) for k, t in enumerate(texts)], "doc_id long, text string, dice double")
    got = {row.doc_id: row for row in licences.scan(frame).collect()}
    for k, text in enumerate(texts):
        want = brute_licences(text or "", licences.THRESHOLD)
        assert got[k].licences == sorted(want)
        assert got[k].dice == max(want.values(), default=0.0)
        assert got[k].best == (min(want, key=lambda n: (-want[n], n)) if want else None)
    assert licences.scan(frame.limit(0)).count() == 0


@pytest.mark.parametrize("sources", [20, 300])
def test_schedule_keeps_to_the_target_weights(sources):
    weights = [(1000.0 if k == 0 else 7.3 + k % 3) ** 0.7 for k in range(sources)]
    share = [Fraction(w) / sum(map(Fraction, weights)) for w in weights]
    order = [(s, t) for s, _, t in mixing.schedule(weights, [int(x * 3000) + 1 for x in share])]
    seen, dry = [0] * sources, next(t for s, t in order if t >= 2500)
    for s, t in order:
        if t >= dry:
            break
        assert t == sum(seen)
        seen[s] += 1
        assert all(abs(x * (t + 1) - n) < 1 for x, n in zip(share, seen))


def test_schedule_of_dry_sources_has_all_blocks_in_their_windows():
    weights, blocks = [5.0, 1e-3, 2.0], [3, 4, 40]
    got = list(mixing.schedule(weights, blocks))
    assert len({t for _, _, t in got}) == len(got) == 47
    for s, n in enumerate(blocks):
        assert [j for x, j, _ in got if x == s] == list(range(n))
    share = [Fraction(w) / sum(map(Fraction, weights)) for w in weights]
    assert all(j / share[s] - 1 < t < (j + 1) / share[s] for s, j, t in got)


def test_encoder_agrees_with_an_untouched_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        definition = f.read()
    tokenizer, encoder = Tokenizer.from_str(definition), token_files.PieceEncoder(definition, plain_specials=False)
    r = random.Random(3)
    bits = ["<|endoftext|>", "a", " ", " b", ",", "\n", "  ", "é", "word", " word", "<|", "|>", "endoftext", ".", "　", "\n\n"]
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x, y<|endoftext|>, z w", "<|endof", "text|> q", "", *ODD]
    texts += ["".join(r.choices(bits, k=r.randint(1, 30))) for _ in range(2000)]
    for _ in range(2):
        ids, sizes = encoder.encode(pa.array(texts))
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert sizes.tolist() == [len(x) for x in want]
        assert ids.tolist() == [i for x in want for i in x]
    assert 50256 in want[0]
