import glob
import os
import subprocess
import sys

import numpy as np
import pytest

from stellate.llm.licenses import CERTAINTY, HASHES, ROWS, TEMPLATES, Scanner, Template, as_template, bands_needed, geometry, least_similarity, license_digests, normal_words, read_templates, scan_licenses
from tests.llm.helpers import corpus, frame, prose


def shingles(text):
    w = normal_words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


TEXTS = {n: t.text for n, t in TEMPLATES.items()}


def variants(a, b):
    a, b = shingles(a), shingles(b)
    return 2 * len(a & b) >= min(len(a), len(b))


def brute(text, templates=None):
    """Names of the templates in a text with at most one notice of each family."""
    templates = {n: as_template(t) for n, t in (templates or TEMPLATES).items()}
    have, line = shingles(text), b" " + b" ".join(normal_words(text)) + b" "
    found = {}
    for n, t in templates.items():
        own = shingles(t.text)
        phrases = [b" " + b" ".join(normal_words(p)) + b" " for p in t.phrases]
        if len(own & have) >= 0.75 * len(own) and all(p in line for p in phrases):
            found[n] = (len(own & have) / len(own), len(own))
    return sorted(n for n in found if not any(found[o] > found[n] and variants(templates[o].text, templates[n].text) for o in found))


def changed(text, k, seed):
    words = text.split()
    for i in np.random.default_rng(seed).choice(len(words), k, replace=False):
        words[i] = f"other{i}"
    return " ".join(words)


@pytest.mark.parametrize("offset", range(0, 40, 3))
def test_found_at_any_offset(offset):
    scanner = Scanner(TEMPLATES)
    for name, text in TEXTS.items():
        found = scanner.scan(prose(offset, offset) + "\n" + text.upper() + ". " + prose(1, 70))
        assert name in [f[0] for f in found]
        hit = next(f for f in found if f[0] == name)
        assert (hit[1], hit[3]) == (offset, 1.0)


def test_changed_texts_match_brute_force():
    scanner = Scanner(TEMPLATES)
    texts = [prose(s, 30) + " " + changed(t, k, s) + " " + prose(s + 1, 40) for t in TEXTS.values() for k in (0, 1, 2) for s in range(6) if len(t.split()) > 4 + k]
    for t in texts:
        assert [f[0] for f in scanner.scan(t)] == brute(t)


def test_bands_guarantee_collision():
    assert ROWS >= 2
    for own in range(1, 9000, 7):
        s = least_similarity(own)
        assert s >= 0.5 and 1 - (1 - s**ROWS) ** bands_needed(s) >= CERTAINTY and bands_needed(s) * ROWS <= HASHES


@pytest.mark.parametrize("own", [1, 2, 7, 8, 15, 16, 17, 31, 100, 255, 256, 5600])
def test_any_run_lies_in_a_window(own):
    stride, length = geometry(own)
    assert stride & (stride - 1) == 0 and stride <= max(1, own / 8)
    assert all((p // stride) * stride + stride * length >= p + own for p in range(2 * stride))
    held = -(-3 * own // 4)
    assert least_similarity(own) == held / (own + stride * length - held)


def test_windows_are_those_of_the_guarantee():
    """The minima that are compared are those of ``stride * length`` shingles from every stride on."""
    text = prose(3, 400)
    scanner = Scanner({"t": prose(9, 44), "u": text})
    words = scanner.word_hashes(text)
    line = scanner.shingles(words)
    (tier, own) = (scanner.tiers[-1], len(line))
    stride, length = geometry(own)
    known = next(t for t in tier.templates() if t.name == "u")
    hashes = scanner.hashes(line)
    want = [w for w in range(0, own, stride) if any((hashes[r : r + ROWS, w : w + stride * length].min(axis=1) == known.least[r : r + ROWS]).all() for r in range(0, len(known.least), ROWS))]
    assert [a for a, _ in scanner.collisions(line, tier)["u"]] == want


@pytest.mark.parametrize("between", [0, 1, 3, 50, 200])
def test_every_notice_is_found(between):
    scanner = Scanner(TEMPLATES)
    for name, text in TEXTS.items():
        n, gap = len(normal_words(text)), prose(5, between)
        found = [f for f in scanner.scan(f"{prose(1, 20)} {text} {gap} {text}\n{text} {gap}") if f[0] == name]
        first = [20, 20 + n + between, 20 + 2 * n + between]
        assert found == [(name, i, i + n - 1, 1.0) for i in first]


def test_notice_after_a_part_of_one():
    words = TEXTS["gpl-3-header"].split()
    found = [f for f in Scanner(TEMPLATES).scan(" ".join([*words[15:], *words])) if f[0] == "gpl-3-header"]
    assert found == [("gpl-3-header", len(words) - 15, len(words) - 16 + len(normal_words(TEXTS["gpl-3-header"])), 1.0)]


def names(text, templates=TEMPLATES):
    return [f[0] for f in Scanner(templates).scan(text)]


def test_versions_and_variants_are_told_apart():
    assert normal_words("Version 2.0, É") == [b"version", b"2", b"0", "É".encode()]
    for a in TEXTS:  # every template is found as itself and as no variant
        assert names(f"{prose(1, 30)} {TEXTS[a]} {prose(2, 30)}") == [a]
    for old, new, text in [("3.0", "2.5", "cc-by-3"), ("version 3", "version 4", "gpl-3-header"), ("version 3", "version 2", "lgpl-3"), ("2.0", "1.1", "apache-2"), ("BY-NC", "BY-ND", "cc-by-nc-4")]:
        assert names(TEXTS[text].replace(old, new)) == []
    assert names(TEXTS["gpl-3-header"].replace("version 3", "version 2").replace("Foundation,", "Foundation;")) == ["gpl-2-header"]
    assert names(TEXTS["cc-by-4"].replace("Attribution 4.0", "Attribution 3.0")) == ["cc-by-3"]
    assert names(TEXTS["gpl-3-header"].replace("GNU General", "GNU Lesser General")) == ["lgpl-3-header"]


def test_phrases_of_a_bare_text():
    assert as_template("The Thing, Version 2.1 of May").phrases == ("Version 2.1",) and as_template("no number").phrases == ()
    bare = {"t": "one two three four five six seven eight nine ten eleven version 7 twelve"}
    assert names(bare["t"], bare) == ["t"] and names(bare["t"].replace("7", "8"), bare) == []


def test_templates_without_words_and_of_few():
    templates = {"none": "  -- ", "few": Template("Public Domain")}
    assert names("public domain.", templates) == ["few"] and names("in the public domain", templates) == [] and names("x", {"none": ""}) == []


def test_batches_change_nothing():
    scanner = Scanner({**TEMPLATES, "long": prose(4, 700)})
    texts = [None, "", prose(1, 3), TEXTS["mit"], prose(4, 700), prose(2, 9000) + " " + TEXTS["bsd-3"], TEXTS["gpl-2"] + "\n" + prose(4, 700)] * 2
    assert scanner.scan_all(texts) == [scanner.scan(t) for t in texts]
    assert [[f[0] for f in found] for found in scanner.scan_all(texts)[:7]] == [[], [], [], ["mit"], ["long"], ["bsd-3"], ["gpl-2", "long"]]


COMMON = "/usr/share/common-licenses"


@pytest.mark.skipif(not os.path.isdir(COMMON), reason="no license texts on this machine")
def test_whole_texts_from_a_folder(spark, tmp_path):
    for path in glob.glob(COMMON + "/*"):
        if not os.path.islink(path):
            (tmp_path / (os.path.basename(path) + ".txt")).write_bytes(open(path, "rb").read())
    templates = read_templates(spark, str(tmp_path))
    assert {"GPL-2", "GPL-3", "LGPL-3", "Apache-2.0"} <= set(templates)
    rows = [(i, f"{prose(i, 40)} {changed(templates[n], 6, i) if len(templates[n]) > 15_000 else templates[n]} {prose(i, 90)}") for i, n in enumerate(sorted(templates))]
    found = {r["doc_id"]: [f["name"] for f in r["found"]] for r in scan_licenses(frame(spark, rows), templates).collect()}
    for i, n in enumerate(sorted(templates)):
        assert n in found[i] and not {m for m in found[i] if m.split("-")[0] == n.split("-")[0]} - {n}, (n, found[i])
    with pytest.raises(ValueError, match="at most 1000"):
        read_templates(spark, str(tmp_path), most_bytes=1000)


def test_memory_of_a_text_of_many_megabytes():
    code = """
import resource
from stellate.llm.licenses import TEMPLATES, Scanner
from tests.llm.helpers import prose
scanner = Scanner(TEMPLATES)
text = (prose(1, 60000) + " " + TEMPLATES["mit-text"].text + " ") * 130
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
found = scanner.scan(text)
print(len(text), len(found), {f[0] for f in found}, (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) > 50_000_000 and out[1:3] == ["130", "{'mit-text'}"] and int(out[3]) < 500


def test_rows(spark):
    docs = corpus() + [(800, "x y " + TEXTS["mit"]), (None, TEXTS["gpl-3"]), (800, "x y " + TEXTS["mit"])]
    rows = license_digests(scan_licenses(frame(spark, docs))).collect()
    assert len(rows) == len(docs)
    assert sorted((str(r["doc_id"]), r["licenses"], r["first_word"], r["n_licenses"]) for r in rows if r["n_licenses"]) == [("800", "mit", 2, 1), ("800", "mit", 2, 1), ("None", "gpl-3", 0, 1)]
    assert scan_licenses(frame(spark, [])).count() == 0
