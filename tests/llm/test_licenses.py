"""License scans against a plain version."""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from tidemark.llm import licenses
from tidemark.llm.queries import QUERIES, tree_path

APACHE = licenses.TEMPLATES[4][1]
MIT = "Released under the MIT License."
GPL = "This work is licensed under the GNU General Public License, version 3."
FILES = [
    (1, "LICENSE", APACHE),
    (2, "a/x.py", "no notice here"),
    (3, "a/b/COPYING.txt", "Copyright\n\n" + licenses.TEMPLATES[2][1]),
    (4, "a/b/c/y.py", None),
    (5, "a/b/c/z.py", "code\n" + GPL + "\n" + "other words " * 500),
    (6, "a/bb/y.py", ""),
    (7, "a/b/notlicense", "the license of this and the software"),
    (8, None, "no path"),
    (None, "a/b/q", MIT + "\nand\nLicensed under CC BY-NC 4.0."),
    (None, "a/b/q", MIT + "\nand\nLicensed under CC BY-NC 4.0."),
    (11, "top", "x"),
    (12, "d/LICENSE", "nothing known"),
    (13, "d/e", "Released under the MIT licence."),
    (14, "e/NOTICE", "\n".join(re.findall(r".{1,60}(?:\s|$)", APACHE))),
    (15, "e/f/g/h", "é"),
    (16, "w/x", "é " + GPL + " é"),
    (17, "a/b/COPYING", MIT),
]


def plain(files, threshold=0.7):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    known = [(name, Counter(words(t))) for name, t in licenses.TEMPLATES]
    has = Counter(w for _, c in known for w in c)

    def vector(counts):
        v = {w: (1 + math.log(n)) * math.log(1 + len(known) / max(1, has[w])) for w, n in counts.items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / size for w, x in v.items()}

    vectors = [(name, vector(c)) for name, c in known]
    own = []
    for _, _, text in files:
        text, found = text or "", []
        for unit in {*text.split("\n"), *re.split(r"\n[ \t]*\n\s*", text), text}:
            v = vector(Counter(words(unit))) if words(unit) else {}
            score, name = min((-round(sum(v.get(w, 0) * x for w, x in t.items()), 6), n) for n, t in vectors)
            if -score >= threshold:
                found.append((score, name))
        own.append(sorted(found))
    out = []
    for (key, path, _), found in zip(files, own, strict=True):
        if found:
            names = ",".join(sorted({n for _, n in found}))
            out.append((key, path, found[0][1], -found[0][0], names, path))
            continue
        best = None
        for (_, other, _), given in zip(files, own, strict=True):
            folder, _, name = (other or "").rpartition("/")
            named = re.match(r"(?i)(licen[cs]e|copying|unlicense|copyright|notice)([._-].*)?$", name)
            if given and named and path and (folder == "" or path.startswith(folder + "/")):
                best = min(best or (1,), (-len(folder), given[0][0], other, given[0][1]))
        out.append((key, path, best and best[3], None, None, best and best[2]))
    return sorted(out, key=str)


def scanned(spark, files, **options):
    docs = spark.createDataFrame(files, "doc_id long, path string, text string")
    got = licenses.scan(docs, licenses.template_table(spark), F.col("path"), **options)
    return sorted(map(tuple, got.collect()), key=str)


def test_scan_is_the_plain_version(spark):
    for threshold in (0.7, 0.4):
        assert scanned(spark, FILES, threshold=threshold) == plain(FILES, threshold)
    by_id = {r[0]: r for r in scanned(spark, FILES)}
    assert by_id[2][2] == "Apache-2.0" and by_id[2][5] == "LICENSE"
    assert by_id[4][2] == "MIT" and by_id[5][2] == "GPL-3.0" and by_id[8][2] is None
    assert by_id[None][4] == "CC-BY-NC-4.0,MIT"
    assert scanned(spark, []) == []


def test_every_license_line_of_the_table_is_found(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op3_license_scans"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    line = {t: n for n, t in licenses.TEMPLATES}
    for d in docs:
        want = sorted({line[x] for x in (d.text or "").split("\n") if x in line})
        assert (got[d.doc_id].licenses or "") == ",".join(want)


def test_documents_inherit_in_the_tree_of_their_source(spark, base):
    lines = [APACHE, MIT, GPL, "Licensed under CC BY 4.0."]
    rows = [(i, f"some words\n{lines[i % 4]}" if i % 3 == 0 else "some words", "s") for i in range(450)]
    rows += [(i, MIT if i == 9024 else "x", None) for i in range(9000, 9100)]
    rows += [(-7, "x", "t/u"), (2**62, None, "s"), (None, GPL, "s"), (7, "twice", "s"), (None, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs.withColumns({"lang": F.lit("en"), "n_chars": F.length("text").cast("long")}).write.parquet(
        f"{base}/documents.parquet"
    )
    got = QUERIES["op3_license_scans"](spark, base)
    paths = docs.select("*", tree_path().alias("path")).collect()
    want = plain([(r.doc_id, r.path, r.text) for r in paths])
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert {"s", "", "t/u/0/0/-7"} <= {r.path for r in paths}
    depths = {
        (path.count("/"), giver.count("/"))
        for _, path, _, score, _, giver in want if giver and score is None
    }
    # Of the folder, of the package for its folders, and for a file of its own.
    assert depths >= {(3, 3), (3, 2), (2, 2)}
