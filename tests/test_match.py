"""Anchor search and parsing against a plain search of every position, and the micro reads of FIXTURES.md."""

import random

import pytest

from umitally.functions import match
from umitally.plans.layout import ReadLayout

MICRO = ReadLayout("ACGTAC", "TTGGCC", 4, min_umi=1, max_umi=5, max_errors=1)


def distance(a, b):
    return sum(x != y for x, y in zip(a, b, strict=True))


def best(text, anchor, limit, begin, end):
    found = [(distance(text[p : p + len(anchor)], anchor), p) for p in range(begin, end - len(anchor) + 1)]
    return min([(e, p) for e, p in found if e <= limit], default=(None, -1))[1]


def plain_parse(s, o):
    a, b, gap = len(o.inner5), len(o.inner3), o.barcode_length
    found = []
    for p in range(len(s) - a - b - gap + 1):
        e5, e3 = distance(s[p : p + a], o.inner5), distance(s[p + a + gap : p + a + gap + b], o.inner3)
        if e5 <= o.max_errors and e3 <= o.max_errors:
            found.append((e5 + e3, p))
    if not found:
        return None
    p = min(found)[1]
    begin, end, ce = 0, len(s), p + a + gap + b
    if o.outer5:
        q = best(s, o.outer5, o.max_errors, 0, p)
        if q < 0:
            return None
        begin = q + len(o.outer5)
    if o.outer3:
        end = best(s, o.outer3, o.max_errors, ce, len(s))
        if end < 0:
            return None
    u5, u3 = s[begin:p], s[ce:end]
    if not all(o.min_umi <= len(u) <= o.max_umi for u in (u5, u3)):
        return None
    return u5, s[p + a : p + a + gap], u3


def parsed(seqs, layout):
    return [None if r[0] < 0 else (s[r[0] : r[1]], s[r[2] : r[2] + layout.barcode_length], s[r[3] : r[4]]) for s, r in zip(seqs, match.parse(seqs, layout).tolist(), strict=True)]


@pytest.mark.parametrize(
    ("read", "changes", "expected"),
    [
        ("GGACGTACCATGTTGGCCAA", {}, ("GG", "CATG", "AA")),
        ("GGACGAACCATGTTGCCCAA", {}, ("GG", "CATG", "AA")),
        ("GGACGAAGCATGTTGGCCAA", {}, None),
        ("GACGTAACATGTTGGCCGACGTACGATCTTGGCCA", {"max_umi": 30}, ("GACGTAACATGTTGGCCG", "GATC", "A")),
        ("GACGTAACATGTTGGCCGACGTACGATCTTGGCCA", {}, None),
        ("GACGTACCATGTTGGCCGACGTACGATCTTGGCCA", {"max_umi": 30}, ("G", "CATG", "GACGTACGATCTTGGCCA")),
        ("ACGTACCATGTTGGCCAA", {}, None),
        ("ACGTACCATGTTGGCCAA", {"min_umi": 0}, ("", "CATG", "AA")),
        ("GGACGTACCATGTTGGCCAAAAAA", {}, None),
        ("ACGTACTTGGCC", {"min_umi": 0}, None),
        ("GGACGTACCANGTTGGCCAA", {}, ("GG", "CANG", "AA")),
        ("GGACNTACCATGTTGGCCAA", {}, ("GG", "CATG", "AA")),
        ("ggacgtaccatgttggccaa", {}, None),
        ("CCCAGGACGTACCATGTTGGCCAATGAG", {"outer5": "CCCA", "outer3": "TGAG"}, ("GG", "CATG", "AA")),
        ("GGACGTACCATGTTGGCCAATGAG", {"outer5": "CCCA", "outer3": "TGAG"}, None),
        ("CCCAGCCCAGGACGTACCATGTTGGCCAATGAG", {"outer5": "CCCA", "outer3": "TGAG", "max_umi": 9}, ("GCCCAGG", "CATG", "AA")),
        ("CCTAGCCCAGGACGTACCATGTTGGCCAATGAG", {"outer5": "CCCA", "outer3": "TGAG", "max_umi": 9}, ("GG", "CATG", "AA")),
        ("", {"min_umi": 0}, None),
    ],
)
def test_micro_reads(read, changes, expected):
    assert parsed([read], MICRO.with_(**changes)) == [expected]


@pytest.mark.parametrize("outer", [{}, {"outer5": "CAC"}, {"outer3": "GTG"}, {"outer5": "CAC", "outer3": "GTG"}])
@pytest.mark.parametrize("errors", [0, 1, 2])
def test_random_reads_equal_plain_search(outer, errors):
    rng = random.Random(errors)
    layout = ReadLayout("ACGTA", "TGGC", 3, min_umi=0, max_umi=40, max_errors=errors, **outer)
    seqs = ["".join(rng.choice("ACGT") for _ in range(rng.randint(0, 40))) for _ in range(400)]
    seqs += ["GG" + s[:5] + "ACGTAAAATGGC" + s[5:12] for s in seqs] + ["É" + s for s in seqs[:50]]
    assert parsed(seqs, layout) == [plain_parse(s, layout) for s in seqs]


def test_c_limits():
    s = "A" * 300 + "ACGTACCATGTTGGCC" + "AA"
    layout = MICRO.with_(max_umi=350)
    assert parsed([s], layout)[0] is not None
    assert parsed([s], layout.with_(c_limits=True)) == [None]
    assert MICRO.with_(max_umi=381, c_limits=True).max_umi == 381
    with pytest.raises(ValueError):
        MICRO.with_(max_umi=382, c_limits=True)  # 4 + 2 * 382 + 3 places do not fit


def plain_edit(s, o):
    """One read at a time by the regex package."""
    import regex

    fuzzy = lambda a: f"(?:{regex.escape(a)}){{e<={o.max_errors}}}"
    m = regex.search(f"(?b){fuzzy(o.inner5)}(.{{{o.barcode_length}}}){fuzzy(o.inner3)}", s)
    if not m:
        return None
    begin, end = 0, len(s)
    if o.outer5:
        x = regex.search(fuzzy(o.outer5), s[: m.start()])
        if not x:
            return None
        begin = x.end()
    if o.outer3:
        x = regex.search(fuzzy(o.outer3), s[m.end() :])
        if not x:
            return None
        end = m.end() + x.start()
    u5, u3 = s[begin : m.start()], s[m.end() : end]
    return (u5, m[1], u3) if all(o.min_umi <= len(u) <= o.max_umi for u in (u5, u3)) else None


@pytest.mark.parametrize("outer", [{}, {"outer5": "CAC"}, {"outer3": "GTG"}, {"outer5": "CAC", "outer3": "GTG"}])
@pytest.mark.parametrize("errors", [0, 1, 2])
def test_edit_mode_equals_reads_one_by_one(outer, errors):
    rng = random.Random(10 + errors)
    layout = ReadLayout("ACGTA", "TGGC", 3, min_umi=0, max_umi=40, max_errors=errors, mode="edit", **outer)
    random_dna = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    seqs = [random_dna(rng.randint(0, 30)) for _ in range(200)]
    core = lambda: "ACGTA" + random_dna(3) + "TGGC"
    seqs += [random_dna(rng.randint(0, 9)) + "".join(core() + random_dna(rng.randint(0, 6)) for _ in range(rng.randint(1, 3))) for _ in range(200)]
    seqs += [s[: rng.randint(0, len(s))] + rng.choice(["", "A", "\n", "É"]) + s[rng.randint(0, len(s)) :] for s in seqs]
    assert parsed(seqs, layout) == [plain_edit(s, layout) for s in seqs]


@pytest.mark.parametrize("seed", range(4))
def test_edits_against_patterns(seed):
    """Anchors of few letters, which align in many ways, and up to three errors, against the pattern search."""
    rng = random.Random(seed)
    for errors in range(4):
        letters = rng.choice(["AC", "ACGT", "ACGT\n"])
        made = lambda n: "".join(rng.choice(letters) for _ in range(n))  # noqa: E731, B023
        layout = ReadLayout(made(6 + seed), made(5 + errors), 3, outer5=rng.choice([None, made(5)]), outer3=rng.choice([None, made(5)]), min_umi=0, max_umi=99, max_errors=errors, mode="edit")

        def worn(s):
            s = list(s)
            for _ in range(rng.randint(0, errors + 1)):  # noqa: B023
                i = rng.randrange(len(s) + 1)
                s[i : i + rng.randint(0, 1)] = rng.choice(["", "A", "C"])
            return "".join(s)

        seqs = [made(rng.randint(0, 9)) + worn(layout.outer5 or "A") + worn(layout.inner5) + made(3) + worn(layout.inner3) + worn(layout.outer3 or "C") + made(rng.randint(0, 9)) for _ in range(300)] + ["", "A"]
        assert parsed(seqs, layout) == [plain_edit(s, layout) for s in seqs]


def test_edit_mode():
    layout = MICRO.with_(mode="edit")
    assert parsed(["GGACGTACCATGTTGGCCAA", "GGACGACCATGTTGGCCAA", "GGACGTTACCATGTTGGCCAA"], layout) == [("GG", "CATG", "AA")] * 3
    # The outer search takes the first acceptable match, not the best.
    outer = layout.with_(outer3="ACGT", max_umi=9)
    assert parsed(["GGACGTACCATGTTGGCCACTTACGT"], outer)[0] is None  # its first match begins at once, so umi3 is empty
    assert parsed(["GGACGTACCATGTTGGCCACTTACGT"], outer.with_(mode="hamming")) == [("GG", "CATG", "ACTT")]


def test_edit_regex_anchors():
    layout = ReadLayout("AC[GT]TAC", "TTGGCC", 4, max_errors=0, mode="edit", regex_anchors=True)
    assert parsed(["GGACTTACCATGTTGGCCAA"], layout) == [("GG", "CATG", "AA")]
    assert parsed(["GGACTTACCATGTTGGCCAA"], layout.with_(regex_anchors=False)) == [None]


def test_bounded_hamming():
    assert match.bounded_hamming(["ACGT", "AAAA", "TTTT", "AC", ""], "ACGT", 2).tolist() == [0, 3, 3, -1, -1]


@pytest.mark.parametrize("bad", [{"barcode_length": 0}, {"inner5": ""}, {"mode": "other"}, {"max_errors": -1}, {"regex_anchors": True}])
def test_layout_is_validated(bad):
    with pytest.raises(ValueError):
        MICRO.with_(**bad)


def test_empty_outer_is_not_given():
    assert MICRO.with_(outer5="", outer3="").outer5 is None
