"""Licence scan by digests of canonical texts (operator 1).

A text is made canonical as one sequence of words: lower case, punctuation, white space and line
breaks to single spaces, spellings that mean the same to one of them. Its SHA-256 is joined to the
digests of the known licence texts, with all its words and without its lines that state a copyright
(a year, a sign or the place for one follows the word; a line of a licence that happens to begin with
"copyright holders" stays). Known texts have both forms, too, so neither a holder's line nor where
lines break matters. Each line is also looked up for itself (a notice such as "Released under the MIT
License." stands in a line of its own), of a copyright line each sentence after the first.

Only DataFrame functions. The digests are a join key, so whatever the size of the known table
Spark chooses how to join; a line that very many documents share is counted once a document
and its key can be split by Spark. Null texts and texts without words match nothing, as do
known texts without words. A text that several known ones equal is given all their ids.
Repeated ids of documents are reported once for all of their rows.
"""

from __future__ import annotations

import pkgutil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kelda.llm.tables import stored

# Spellings that count as the same (left: as found, right: as compared), as licence matching
# guidelines commonly list them. Fixed values.
SAME = {
    "acknowledgement": "acknowledgment",
    "analyse": "analyze",
    "artefact": "artifact",
    "authorisation": "authorization",
    "authorised": "authorized",
    "cancelled": "canceled",
    "centre": "center",
    "copyrights": "copyright",
    "emphasised": "emphasized",
    "favour": "favor",
    "fulfil": "fulfill",
    "fulfilment": "fulfillment",
    "https": "http",
    "initialise": "initialize",
    "judgement": "judgment",
    "labelling": "labeling",
    "labour": "labor",
    "licence": "license",
    "licenced": "licensed",
    "licencee": "licensee",
    "licences": "licenses",
    "merchantibility": "merchantability",
    "modelled": "modeled",
    "noncommercial": "non commercial",
    "organisation": "organization",
    "practise": "practice",
    "programme": "program",
    "realise": "realize",
    "recognise": "recognize",
    "signalling": "signaling",
    "sublicence": "sublicense",
    "utilisation": "utilization",
    "v2": "version 2",
    "v3": "version 3",
    "whilst": "while",
    "wilful": "willful",
}

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including
without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial
portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO
EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER
IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE
USE OR OTHER DEALINGS IN THE SOFTWARE."""

_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without
fee is hereby granted"""

_ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE
LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING
OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

# Known texts: (licence id, text). Whole licences, and notices as they stand in documents.
KNOWN = [
    ("MIT", _MIT),
    ("MIT", "MIT License\n\n" + _MIT),
    (
        "ISC",
        _ISC_GRANT
        + ", provided that the above copyright notice and this permission notice appear in all copies.\n\n"
        + _ISC_WARRANTY,
    ),
    ("0BSD", _ISC_GRANT + ".\n\n" + _ISC_WARRANTY),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "This work is licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    (
        "CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This work is licensed under the MIT License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
]

# Whole licences in ``license_texts``: (file, ids). A GNU text is the same for both of its ids.
FILES = [
    ("Apache-2.0", ["Apache-2.0"]),
    ("Artistic", ["Artistic-1.0-Perl"]),
    ("CC0-1.0", ["CC0-1.0"]),
    ("GFDL-1.2", ["GFDL-1.2-only", "GFDL-1.2-or-later"]),
    ("GFDL-1.3", ["GFDL-1.3-only", "GFDL-1.3-or-later"]),
    ("GPL-1", ["GPL-1.0-only", "GPL-1.0-or-later"]),
    ("GPL-2", ["GPL-2.0-only", "GPL-2.0-or-later"]),
    ("GPL-3", ["GPL-3.0-only", "GPL-3.0-or-later"]),
    ("LGPL-2", ["LGPL-2.0-only", "LGPL-2.0-or-later"]),
    ("LGPL-2.1", ["LGPL-2.1-only", "LGPL-2.1-or-later"]),
    ("LGPL-3", ["LGPL-3.0-only", "LGPL-3.0-or-later"]),
    ("MPL-1.1", ["MPL-1.1"]),
    ("MPL-2.0", ["MPL-2.0"]),
]
_END = "END OF TERMS AND CONDITIONS"

# Notices: every name after every phrase.
NAMES = {
    "0BSD": ["the Zero-Clause BSD License", "the 0BSD License"],
    "Apache-2.0": ["the Apache License, Version 2.0", "the Apache License 2.0", "the Apache 2.0 License", "Apache-2.0"],
    "BSD-2-Clause": ["the BSD 2-Clause License", "the Simplified BSD License", "BSD-2-Clause"],
    "BSD-3-Clause": ["the BSD 3-Clause License", "the New BSD License", "BSD-3-Clause"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal", "the CC0 1.0 Universal License"],
    "CC-BY-4.0": ["CC BY 4.0", "a Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "ISC": ["the ISC License"],
    "MIT": ["the MIT License", "MIT"],
    "MPL-1.1": ["the Mozilla Public License, Version 1.1", "the Mozilla Public License 1.1", "MPL-1.1"],
    "MPL-2.0": ["the Mozilla Public License, Version 2.0", "the Mozilla Public License 2.0", "MPL-2.0"],
}
for _id, _name, _versions in (
    ("GPL", "General", ("2", "3")),
    ("LGPL", "Lesser General", ("2.1", "3")),
    ("AGPL", "Affero General", ("3",)),
):
    for _v in _versions:
        _full = _v if "." in _v else f"{_v}.0"
        _only = [f"the GNU {_name} Public License{x}{v}" for x in (", version ", " v", " ") for v in {_v: 0, _full: 0}]
        NAMES[f"{_id}-{_full}-only"] = [*_only, f"{_id}-{_full}-only"]
        _later = [f"{n}{x}" for n in _only for x in (" or later", " or any later version", " or (at your option) any later version")]
        NAMES[f"{_id}-{_full}-or-later"] = [*_later, f"{_id}-{_full}-or-later"]
PHRASES = [
    f"{start}{verb} under {terms}{{}}"
    for start in ("", "This work is ", "This project is ", "This software is ", "This program is ", "This file is ")
    for verb in ("Licensed", "Released", "Distributed", "Published", "Made available")
    for terms in ("", "the terms of ")
]


def _texts() -> list[tuple[str, str]]:
    """Whole licences of the data files, those with an appendix also without it."""
    read = lambda name: pkgutil.get_data(__name__, f"license_texts/{name}.txt").decode()
    found = []
    for name, ids in FILES:
        text = read(name)
        forms = [text, text[: text.index(_END) + len(_END)]] if _END in text else [text]
        forms += [text[: text.index(_END)]] if _END in text else []
        found += [(i, form) for i in ids for form in forms]
    regents = read("BSD")
    bsd = regents.replace("the University nor", "the copyright holder nor")
    bsd = bsd.replace("REGENTS AND", "COPYRIGHT HOLDERS AND").replace("REGENTS OR", "COPYRIGHT HOLDER OR")
    two = bsd[: bsd.index("3. Neither")] + bsd[bsd.index("THIS SOFTWARE") :]
    for i, title, text in (
        ("BSD-3-Clause", "BSD 3-Clause License", regents),
        ("BSD-3-Clause", "BSD 3-Clause License", bsd),
        ("BSD-2-Clause", "BSD 2-Clause License", two),
    ):
        found += [(i, text), (i, f"{title}\n\n{text}")]
    return found


KNOWN += _texts()
KNOWN += [(i, phrase.format(name)) for i, names in NAMES.items() for name in names for phrase in PHRASES]

NOT_WORD = r"[^\p{L}\p{N}]+"
#: A line that states a copyright, in lower case.
STATEMENT = (
    r"^[^\p{L}\p{N}(©]*(copyright[\s:,]*(\(c\)|©)|(copyright|\(c\)|©)[\s:,]*([<\[(]?(year|yyyy)|[0-9]{4}))"
    r"|^[^\p{L}\p{N}]*all rights reserved[^\p{L}\p{N}]*$"
)
SENTENCE = r"\.\s+"


def _words(text: Column) -> Column:
    """The words of a text in lower case, spelled alike, with single spaces."""
    same = F.create_map(*(F.lit(x) for pair in SAME.items() for x in pair))
    found = F.filter(F.split(text, NOT_WORD), lambda w: w != "")
    # Few words are in the map: a set tells which, the map is only searched for these.
    spelled = lambda w: F.when(w.isin(*SAME), F.try_element_at(same, w)).otherwise(w)
    return F.array_join(F.transform(found, spelled), " ")


def canonical_lines(text: Column) -> Column:
    """For each line its canonical words, whether it states a copyright, and if so the canonical words of its
    sentences after the first."""

    def made(line: Column) -> Column:
        said = line.rlike(STATEMENT)
        more = F.slice(F.split(line, SENTENCE), F.lit(2), F.lit(1 << 30))
        none = F.array().cast("array<string>")
        return F.struct(
            _words(line).alias("words"),
            said.alias("said"),
            F.when(said, F.transform(more, _words)).otherwise(none).alias("more"),
        )

    return F.transform(F.split(F.lower(text), "\n"), made)


def wholes(lines: Column) -> Column:
    """The whole text's canonical forms: all its words, and those of lines that state no copyright."""
    joined = lambda chosen: F.array_join(F.transform(F.filter(chosen, lambda x: x["words"] != ""), lambda x: x["words"]), " ")
    forms = F.array(joined(lines), joined(F.filter(lines, lambda x: ~x["said"])))
    return F.array_distinct(F.filter(forms, lambda x: x != ""))


def notices(lines: Column) -> Column:
    """The canonical forms of what is looked up for itself."""
    own = F.transform(F.filter(lines, lambda x: ~x["said"]), lambda x: x["words"])
    every = F.concat(own, F.flatten(F.transform(lines, lambda x: x["more"])))
    return F.array_distinct(F.filter(every, lambda x: x != ""))


def digest(canonical: Column) -> Column:
    return F.sha2(canonical.cast("binary"), 256)


def known_digests(texts: DataFrame, id_col: str = "license_id", text_col: str = "text") -> DataFrame:
    """(digest, license_id) of known licence texts, each pair once."""
    made = texts.select(
        F.col(id_col).alias("license_id"), F.explode(wholes(canonical_lines(F.col(text_col)))).alias("canonical")
    )
    found = made.where(F.col("license_id").isNotNull())
    return found.select(digest(F.col("canonical")).alias("digest"), "license_id").distinct()


def known_licenses(spark: SparkSession) -> DataFrame:
    """The texts in ``KNOWN``."""
    return spark.createDataFrame(KNOWN, "license_id string, text string")


def license_scan(
    docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every document's id, the licences that its whole text is (``licenses``), those that single
    lines name (``notices``), both sorted and joined by commas, and the number of different
    lines that do (``n_notices``). ``known`` has license_id and text."""
    spark = docs.sparkSession
    # Stored, so that their size is known and Spark broadcasts them if they are few.
    digests = stored(known_digests(known_licenses(spark) if known is None else known), "known-digests")
    lines = docs.select(
        F.col(id_col).alias("id"), canonical_lines(F.col(text_col).cast("string")).alias("l")
    ).where(F.col("l").isNotNull())
    unit = lambda entire: lambda x: F.struct(F.lit(entire).alias("whole"), digest(x).alias("digest"))
    every = F.concat(F.transform(wholes(F.col("l")), unit(True)), F.transform(notices(F.col("l")), unit(False)))
    units = lines.select("id", F.explode(every).alias("u")).select("id", "u.*")
    found = units.join(digests, "digest").groupBy("id").agg(
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("whole"), F.col("license_id")))), ",").alias("licenses"),
        F.array_join(F.sort_array(F.collect_set(F.when(~F.col("whole"), F.col("license_id")))), ",").alias("notices"),
        F.count_distinct(F.when(~F.col("whole"), F.col("digest"))).alias("n_notices"),
    )
    ids = docs.select(F.col(id_col).alias("id")).distinct()
    everything = ids.join(found.withColumnRenamed("id", "_id"), F.col("id").eqNullSafe(F.col("_id")), "left")
    return everything.select(
        F.col("id").alias(id_col),
        F.coalesce("licenses", F.lit("")).alias("licenses"),
        F.coalesce("notices", F.lit("")).alias("notices"),
        F.coalesce("n_notices", F.lit(0)).cast("bigint").alias("n_notices"),
    )


def _sql() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({quote(a)}, {quote(b)})" for a, b in KNOWN)
    pairs = ", ".join(f"{quote(a)}: {quote(b)}" for a, b in SAME.items())
    return f"""
WITH units AS (
  SELECT doc_id, CAST(NULL AS VARCHAR) AS license_id, text FROM documents
  UNION ALL
  SELECT NULL, k.license_id, k.text FROM (VALUES {known}) AS k(license_id, text)
), split AS (
  SELECT row_number() OVER () AS unit, doc_id, license_id, string_split(lower(text), chr(10)) AS l
  FROM units WHERE text IS NOT NULL
), lines AS (
  SELECT unit, doc_id, license_id, i, l[i] AS line, regexp_matches(l[i], '{STATEMENT}') AS said
  FROM (SELECT *, unnest(range(1, len(l) + 1)) AS i FROM split)
), parts AS (
  SELECT unit, doc_id, license_id, i, said, true AS line, line AS t FROM lines
  UNION ALL
  SELECT unit, doc_id, license_id, i, said, false,
         unnest(regexp_split_to_array(line, '{SENTENCE}')[2:]) FROM lines WHERE said
), canonical AS (
  SELECT * EXCLUDE (t), array_to_string(list_transform(
    list_filter(regexp_split_to_array(t, '{NOT_WORD}'), lambda w: w <> ''),
    lambda w: coalesce(MAP {{{pairs}}}[w], w)), ' ') AS c
  FROM parts
), spelled AS (SELECT * FROM canonical WHERE c <> ''),
whole AS (
  SELECT unit, doc_id, license_id, string_agg(c, ' ' ORDER BY i) AS c FROM spelled WHERE line GROUP BY ALL
  UNION
  SELECT unit, doc_id, license_id, string_agg(c, ' ' ORDER BY i) FROM spelled WHERE line AND NOT said GROUP BY ALL
), known AS (SELECT DISTINCT license_id, c FROM whole WHERE license_id IS NOT NULL),
hits AS (
  SELECT w.doc_id, true AS entire, k.license_id, k.c FROM whole w JOIN known k USING (c) WHERE w.license_id IS NULL
  UNION
  SELECT s.doc_id, false, k.license_id, k.c FROM spelled s JOIN known k USING (c)
  WHERE s.license_id IS NULL AND line = NOT said
), found AS (
  SELECT doc_id, list(DISTINCT license_id) FILTER (entire) AS a, list(DISTINCT license_id) FILTER (NOT entire) AS b,
         count(DISTINCT c) FILTER (NOT entire) AS n
  FROM hits GROUP BY doc_id
)
SELECT doc_id, coalesce(array_to_string(list_sort(a), ','), '') AS licenses,
       coalesce(array_to_string(list_sort(b), ','), '') AS notices, CAST(coalesce(n, 0) AS BIGINT) AS n_notices
FROM (SELECT DISTINCT doc_id FROM documents) LEFT JOIN found USING (doc_id)
"""


SQL = _sql()
