from retentio.llm import licenses as L


def scan(spark, docs, known=None):
    frame = spark.createDataFrame([(*d, "l") for d in docs], "doc_id long, text string, license string")
    return {r.doc_id: r for r in L.scan(frame, known if known is not None else L.known_texts(spark)).collect()}


def test_equal_up_to_case_punctuation_spelling_and_copyright(spark):
    got = scan(spark, [
        (1, "RELEASED under the MIT Licence"), (2, "Copyright 2020 A. Person\n(c) B\n  Released under the  MIT\nLicense!"),
        (3, "Some text\nlicenced under CC-BY-NC 4.0\nmore"), (4, "Released under the MIT License. And more."),
        (5, "* © Me\nAll rights reserved\nAll rights reserved"), (6, "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0")])
    assert got[1].license == "MIT" and got[1].line_licenses == "MIT" and got[1].n_license_lines == 1
    assert got[2].license == "MIT" and got[2].line_licenses == ""
    assert (got[3].license, got[3].line_licenses) == ("", "CC-BY-NC-4.0")
    assert (got[4].license, got[4].line_licenses, got[4].n_license_lines) == ("", "", 0)
    assert (got[5].line_licenses, got[5].n_license_lines) == ("reserved", 2)
    assert got[6].license == "MPL-2.0" and got[1].digest == got[2].digest != got[3].digest


def test_edges(spark):
    """Null, empty and copyright-only texts match nothing; rows of one id are
    pooled; names are sorted; a text under two names gives both; empty tables."""
    docs = [(1, None), (2, ""), (3, "Copyright me"), (4, "MIT text"), (4, "All rights reserved."), (5, "x " * 300_000), (None, "MIT text")]
    known = spark.createDataFrame([("b", "mit TEXT"), ("a", "MIT, text"), ("a", "MIT text"), ("none", "..."), ("r", "all rights reserved")], "license string, text string")
    got = scan(spark, docs, known)
    assert set(got) == {1, 2, 3, 4, 5, None}
    assert all((got[k].license, got[k].line_licenses, got[k].n_license_lines) == ("", "", 0) for k in (1, 2, 3, 5))
    assert got[1].digest == got[2].digest == got[3].digest
    assert (got[4].license, got[4].line_licenses) == ("a,b,r", "a,b,r") and got[None].license == "a,b"
    assert scan(spark, [], known) == {} and scan(spark, docs, known.limit(0))[4].license == ""


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""


def test_full_texts_and_runs_of_lines(spark):
    """A whole licence, alone or inside a document, commented or wrapped anew; a notice over two lines."""
    words = MIT.split()
    wrapped = "\n".join(" ".join(words[k:k + 7]) for k in range(0, len(words), 7))
    at = words.index("COPYRIGHT")
    split = " ".join(words[:at]) + "\n" + " ".join(words[at:])
    got = scan(spark, [
        (1, "MIT License\n\nCopyright (c) 2026 A. Person\n\n" + MIT), (2, "def f():\n" + "\n".join("# " + x for x in MIT.split("\n")) + "\n  pass"),
        (3, wrapped), (4, split), (5, "Before.\nCopyright 2020 Me\n" + split + "\nafter"), (6, MIT.replace("charge", "cost") + "\nx"),
        (7, "intro\nLicensed under the Apache\nLicense, Version 2.0.\nend"), (8, "x\n" + MIT + "\n" + MIT)])
    assert all(got[k].license == "MIT" for k in (1, 3, 4)) and got[3].line_licenses == got[4].line_licenses == ""
    assert all(got[k].license == "" and got[k].line_licenses == "MIT" for k in (2, 5, 8))
    assert got[2].n_license_lines == 15 and got[5].n_license_lines == 2 and got[8].n_license_lines == 30
    assert (got[6].license, got[6].line_licenses, got[6].n_license_lines) == ("", "", 0)
    assert (got[7].line_licenses, got[7].n_license_lines) == ("Apache-2.0", 2)


def plain_canonical(text, dropped):
    """Canonical lines by plain Python."""
    import re
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    t = re.sub(dropped, "\n", t)
    out = []
    for line in t.split("\n"):
        words = re.sub(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ", line).split()
        out.append([dict(L.SPELLINGS).get(w, w) for w in words])
    return [x for x in out if x]


def plain_scan(text, known):
    """(license, line_licenses, n_license_lines) by comparing the whole text, each line and every run of lines."""
    forms = {}
    for name, t in known:
        for dropped in (L.COPYRIGHT_LINE, L.HOLDER_LINE):
            words = tuple(w for x in plain_canonical(t, dropped) for w in x)
            if words:
                forms.setdefault(words, set()).add(name)
    lines, body = plain_canonical(text, L.COPYRIGHT_LINE), plain_canonical(text, L.HOLDER_LINE)
    join = lambda xs: tuple(w for x in xs for w in x)
    whole = forms.get(join(lines), set()) | forms.get(join(body), set())
    parts, count, inside = set(), 0, set()
    for x in lines:
        parts |= forms.get(tuple(x), set())
        count += len(forms.get(tuple(x), ()))  # a line under two names counts for each
    holder = "copyright" in (text or "").lower() or "(c)" in (text or "").lower()
    runs = body if holder else lines
    for i in range(len(runs)):
        for j in range(i + 2, len(runs) + 1):
            if j - i < len(runs) and join(runs[i:j]) in forms and join(runs[i:j]) != join(lines):
                parts |= forms[join(runs[i:j])]
                inside |= set(range(i, j))
    return ",".join(sorted(whole)), ",".join(sorted(parts)), count + len(inside)


def test_scan_matches_brute_force(spark):
    import random
    rng = random.Random(9)
    known = [("A", "Permission is granted to use this licence, version 2."), ("A", "Use this licence."), ("B", "Released to all\nwithout any favour"),
             ("C", "Copyright holders give v 3 of this to you"), ("D", "all rights reserved"), ("E", "use this license")]
    texts = []
    for _ in range(150):
        parts = []
        for _ in range(rng.randint(1, 4)):
            words = rng.choice(known)[1].split() if rng.random() < 0.7 else [rng.choice(["use", "this", "license", "all", "plain", "words"]) for _ in range(rng.randint(0, 5))]
            cut = rng.choice([2, 3, 5, 50])
            parts.append("\n".join(rng.choice(["", "# ", " * "]) + " ".join(words[k:k + cut]).upper() for k in range(0, len(words), cut)))
            if rng.random() < 0.3:
                parts.append(rng.choice(["Copyright 2020 A. Person", "(c) 2021 B", "", "---", "Copyright text goes on"]))
        texts.append("\n".join(parts))
    got = scan(spark, list(enumerate(texts)), spark.createDataFrame(known, "license string, text string"))
    want = {k: plain_scan(t, known) for k, t in enumerate(texts)}
    assert {k: (r.license, r.line_licenses, r.n_license_lines) for k, r in got.items()} == want
    assert sum(bool(w[0]) for w in want.values()) > 5 and sum(w[2] > 1 for w in want.values()) > 30
