"""Licence scans against a plain version."""

import math
import random
import re
from collections import Counter

from samples import PROSE

from clickloom.llm import licences


def plain(rows, templates=licences.TEMPLATES, header_at=licences.HEADER_AT, file_at=licences.FILE_AT):
    vocabulary = {t for n in templates.values() for t in licences.terms_of(n)}
    df = Counter(t for _, _, text in rows for t in set(licences.terms_of(text or "")) & vocabulary)
    weight = {t: math.log((1 + len(rows)) / (1 + df[t])) + 1 for t in vocabulary}
    other = sum(weight.values()) / len(weight)

    def vector(terms):
        return {t: n * weight.get(t, other) for t, n in Counter(terms).items()}

    def best(terms):
        u = vector(terms)
        length = math.sqrt(sum(x * x for x in u.values()))
        options = []
        for name, notice in templates.items():
            v = vector(licences.terms_of(notice))
            dot = sum(x * v.get(t, 0) for t, x in u.items())
            if dot:
                options.append((-round(dot / length / math.sqrt(sum(x * x for x in v.values())), 9), name))
        return min(options) if options else (0, None)

    headers, files, given = {}, {}, {}
    for _, path, text in rows:
        if path is None:
            continue
        lines = [best(licences.terms_of(line)) for line in (text or "").split("\n")]
        lines = [x for x in lines if -x[0] >= header_at]
        if lines:
            headers[path] = min(lines)
        whole = best(licences.terms_of(text or ""))
        if -whole[0] >= file_at:
            files[path] = whole
    for path, x in files.items():
        folder = path.rpartition("/")[0]
        given[folder] = min(given.get(folder, x), x)
    out = []
    for key, path, _ in rows:
        result = (None, None)
        if path is not None:
            folder = path.rpartition("/")[0]
            above = ["/".join(folder.split("/")[:n]) for n in range(folder.count("/") + 1, -1, -1)]
            inherited = next((given[a][1] for a in above if a in given), None)
            if path in headers:
                result = (headers[path][1], "header")
            elif path in files:
                result = (files[path][1], "file")
            elif inherited:
                result = (inherited, "directory")
        out.append((key, path, *result))
    return sorted(out, key=str)


def scanned(spark, rows):
    files = spark.createDataFrame(rows, "doc_id long, path string, text string").selectExpr("*", "1 as unit", "'x' as licence", "'y' as directory")
    return sorted((tuple(r) for r in licences.scan(files, keep=("doc_id",)).collect()), key=str)


def test_against_plain_version(spark):
    rnd = random.Random(6)
    notices = list(licences.TEMPLATES.values())
    rows = []
    for i in range(150):
        folder = "/".join(["r", *(str(rnd.randrange(3)) for _ in range(rnd.randrange(4)))])
        lines = [" ".join(rnd.choice(PROSE) for _ in range(rnd.randrange(1, 14))) for _ in range(rnd.randrange(6))]
        if rnd.random() < 0.25:
            lines.insert(rnd.randrange(len(lines) + 1), rnd.choice(notices) + rnd.choice(["", " indeed so", "\t"]))
        if rnd.random() < 0.1:
            lines = [rnd.choice(notices) + " some more words here to make up a whole file"]
        rows.append((i, f"{folder}/{i}.txt", "\n".join(lines)))
    rows += [(900, "top", notices[0]), (901, "x/y/z", None), (902, "x/y/z", ""), (903, None, notices[1]), (904, "/abs/a", notices[2]), (905, "/abs/b/c", "none")]
    rows += [rows[3], (906, "deep/er", notices[3] + "\n" + "long " * 30_000), (907, "case/1", notices[0].upper())]
    got = scanned(spark, rows)
    assert got == plain(rows)
    assert {r[3] for r in got} == {"header", "file", "directory", None} or {r[3] for r in got} >= {"header", "directory", None}


def plain_all(rows, header_at=licences.HEADER_AT, file_at=licences.FILE_AT):
    """Lines, wholes, sentences and runs against notices, wholes against texts, runs against headers, SPDX lines; no text is left out beforehand."""
    sets = [licences.TEMPLATES, licences.TEXTS, licences.HEADERS]
    models = []
    for templates in sets:
        vocabulary = {t for n in templates.values() for t in licences.terms_of(n)}
        df = Counter(t for _, _, text in rows for t in set(licences.terms_of(text or "")) & vocabulary)
        weight = {t: math.log((1 + len(rows)) / (1 + df[t])) + 1 for t in vocabulary}
        vectors = {}
        for name, notice in templates.items():
            v = {t: n * weight[t] for t, n in Counter(licences.terms_of(notice)).items()}
            length = math.sqrt(sum(x * x for x in v.values()))
            vectors[name] = {t: x / length for t, x in v.items()}
        models.append((weight, sum(weight.values()) / len(weight), vectors))

    def best(model, terms, least):
        weight, other, vectors = model
        u = {t: n * weight.get(t, other) for t, n in Counter(terms).items()}
        length = math.sqrt(sum(x * x for x in u.values()))
        found = [(-round(sum(x * v.get(t, 0) for t, x in u.items()) / length, 9), name) for name, v in vectors.items()] if u else []
        return [x for x in found if -x[0] >= least][:] and [min(x for x in found if -x[0] >= least)]

    def runs(which, terms, least):
        """Where a template would lie, from each place of a term without which the rest of it falls short."""
        for name, v in models[which][2].items():
            own, rest = licences.terms_of(sets[which][name]), 1.0
            for t, x in sorted(v.items(), key=lambda i: (-i[1], i[0])):
                if math.sqrt(max(rest, 0.0)) < least - 1e-9:
                    break
                rest -= x * x
                for at in (i for i, u in enumerate(terms) if u == t):
                    start = max(at - own.index(t), 0)
                    yield terms[start : start + len(own)]

    spelled = {n.lower(): n for some in sets for n in some}
    headers, files, inside, given = {}, {}, {}, {}
    for _, path, text in rows:
        if path is None:
            continue
        text = text or ""
        terms = licences.terms_of(text)
        stated = [x for line in text.split("\n") for x in best(models[0], licences.terms_of(line), header_at)]
        name = r"\(*[A-Za-z0-9][A-Za-z0-9.+-]*\)*"
        for said in re.findall(rf"(?i)SPDX-License-Identifier:[ \t]*({name}(?:[ \t]+(?:AND|OR|WITH)[ \t]+{name})*)", text):
            said = re.sub(r"(?i)[ \t]+WITH[ \t]+[^ \t]+", "", said)
            for one in re.split(r"(?i)[ \t]+(?:AND|OR)[ \t]+", said):
                one = re.sub(r"(?i)(?:-only|-or-later|\+)$", "", re.sub(r"[()]|\.+$", "", one))
                stated.append((-1.0, spelled.get(one.lower(), one)))
        whole = best(models[0], terms, file_at) + best(models[1], terms, file_at)
        parts = [licences.terms_of(s) for s in re.split(r"(?<=[.!?;:])\s+|\n\s*\n", text)]
        inner = [x for p in [*parts, *runs(0, terms, header_at)] for x in best(models[0], p, header_at)]
        inner += [x for p in runs(2, terms, header_at) for x in best(models[2], p, header_at)]
        for into, found in ((headers, stated), (files, whole), (inside, inner)):
            if found:
                into[path] = min(found)
    for path, x in files.items():
        folder = path.rpartition("/")[0]
        given[folder] = min(given.get(folder, x), x)
    out = []
    for key, path, _ in rows:
        result = (None, None)
        if path is not None:
            folder = path.rpartition("/")[0]
            above = ["/".join(folder.split("/")[:n]) for n in range(folder.count("/") + 1, -1, -1)]
            inherited = next((given[a][1] for a in above if a in given), None)
            ways = ((headers.get(path), "header"), (files.get(path), "file"), (inside.get(path), "header"), (inherited and (0, inherited), "directory"))
            result = next(((x[1], basis) for x, basis in ways if x), result)
        out.append((key, path, *result))
    return sorted(out, key=str)


def test_against_plain_version_of_all_units(spark):
    rnd = random.Random(12)
    notices, texts, heads = (list(x.values()) for x in (licences.TEMPLATES, licences.TEXTS, licences.HEADERS))
    short = sorted(texts, key=len)[:6]
    rows = []
    for i in range(90):
        prose = " ".join(rnd.choice(PROSE) for _ in range(rnd.randrange(5, 60)))
        kind = i % 9
        if kind == 0:
            body = rnd.choice(short)[: rnd.choice([400, 4000])]
        elif kind == 1:
            body = "/*\n" + "\n".join(" * " + line for line in rnd.choice(heads).split("\n")) + "\n */\n" + prose
        elif kind == 2:
            body = f"{prose}. {rnd.choice(notices)} {prose}"
        elif kind == 3:
            body = f"{prose} " + rnd.choice(notices).replace(" ", "\n", 2) + f" {prose}"
        elif kind == 4:
            body = f"// SPDX-License-Identifier: {rnd.choice(['MIT', 'gpl-2.0-only', '(MIT OR Apache-2.0)', 'Zlib+', 'GPL-3.0-or-later WITH x'])}\n{prose}"
        elif kind == 5:
            words = licences.terms_of(rnd.choice(notices + heads))
            body = " ".join(w for w in words if rnd.random() > 0.15) + " " + prose
        else:
            body = prose
        rows.append((i, f"d{i % 4}/{'s/' * (i % 3)}{i}", body))
    rows += [(100, None, notices[0]), (101, "d0/x", None), (102, "d1/0", ""), (103, "e/f", "spdx-license-identifier:mit")]
    got = scanned(spark, rows)
    assert got == plain_all(rows)
    assert {r[3] for r in got} == {"header", "file", "directory", None}


def test_licence_file_without_header(spark):
    text = "Released under\nthe MIT\nLicense."
    rows = [(1, "a/LICENSE", text), (2, "a/b/c.txt", "words"), (3, "z/c.txt", "words")]
    assert scanned(spark, rows) == [(1, "a/LICENSE", "MIT", "file"), (2, "a/b/c.txt", "MIT", "directory"), (3, "z/c.txt", None, None)]


def test_notices_inside_lines_and_across_line_ends(spark):
    words = "some words about this thing here and there which go on and on for quite a while"
    rows = [(100 + i, f"z/{i}", words) for i in range(20)]
    rows += [(i, f"{i}/x", f"{words} {notice} {words}") for i, notice in enumerate(licences.TEMPLATES.values())]
    rows += [(20 + i, f"{20 + i}/x", f"{words}\n# {words} " + notice.replace(" ", "\n# ", 3) + f" {words}\n") for i, notice in enumerate(licences.TEMPLATES.values())]
    rows += [(50, "50/x", f"{words}. Released under the MIT License. {words}"), (51, "51/x", f"{words} license {words}")]
    got = {r[0]: r[2:] for r in scanned(spark, rows)}
    for i, name in enumerate(licences.TEMPLATES):
        assert got[i] == got[20 + i] == (name, "header")
    assert got[50] == ("MIT", "header") and got[51] == got[100] == (None, None)


def test_licence_texts_headers_and_spdx_lines(spark):
    words = "some words about this thing here and there which go on and on for quite a while\n"
    rows = [(1000 + i, f"z/{i}", words) for i in range(40)]
    own = "Copyright (c) 2019 Jane Roe and contributors. All rights reserved.\n\n"
    for i, (name, text) in enumerate(licences.TEXTS.items()):
        rows += [(i, f"t/{name}/LICENSE", f"{name} licence\n\n{own}{text}"), (100 + i, f"t/{name}/src/a.c", words)]
    for i, (name, text) in enumerate(licences.HEADERS.items()):
        body = "\n".join(" * " + line for line in f"{own}{text}".split("\n"))
        rows.append((200 + i, f"h{i}/a.c", f"/*\n{body}\n */\n{words * 40}"))
    said = {"MIT": "MIT", "Apache-2.0 */": "Apache-2.0", "GPL-3.0-or-later": "GPL-3.0", "(mit OR Apache-2.0)": "Apache-2.0", "GPL-2.0-only WITH Classpath-exception-2.0": "GPL-2.0", "Zlib": "Zlib"}
    rows += [(300 + i, f"s{i}/a.c", f"// SPDX-License-Identifier: {line}\n{words * 10}") for i, line in enumerate(said)]
    got = {r[0]: r[2:] for r in scanned(spark, rows)}
    for i, name in enumerate(licences.TEXTS):
        assert got[i][0] == name and got[100 + i] == (name, "directory"), (name, got[i], got[100 + i])
    for i, name in enumerate(licences.HEADERS):
        assert got[200 + i][0] == name, (name, got[200 + i])
    assert [got[300 + i] for i in range(len(said))] == [(name, "header") for name in said.values()]
    assert got[1000] == (None, None)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, path string, text string")
    assert licences.scan(empty, keep=("doc_id",)).collect() == []
