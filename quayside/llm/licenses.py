"""Licence scan: sparse TF-IDF cosine of header lines and whole files to templates, then inheritance from directories.

Terms are runs of letters, digits and inner `.+-`, lower-cased. Inverse document frequencies are counted over all files.
Units are
every line, paragraph (lines between such without terms), run of comment lines, block comment, sentence of a paragraph,
and the whole file. A unit's vector is compared with each template's, and the best template of cosine
`min_similarity` or more is the file's own licence. Units that cannot reach that are left out beforehand, exactly: without
one of a template's essential terms (the rarest ones, until the weight of the others falls below the bound) the cosine
stays below it, and so it does if terms of no template keep it there at the least weight a term can have, that of one in
every file. Only for the units then left are the frequencies of such terms counted.

Files without a licence of their own take that of the nearest directory above them, where files that speak for their
directory (by default those named like licence files) state one; the most frequent licence of a directory counts. The
distinct directories are joined with their own ancestors, not files with files.

All steps are built-in functions; only what the templates bound reaches the driver. Defined cases: a null or empty text
has no licence of its own; a null path lies in no directory; of equally good templates the first by name wins; equal rows
are judged each for itself; an empty table gives an empty result; columns that have the name of an output give way to it.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import BROADCAST_ROWS, broadcast_if_small, written
from .text import without

# Notices by which files state well-known licences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
# Licences that read nearly alike are all here, so that none is taken for its neighbour.
_GNU = {
    "GPL-1.0": ("General", "1", "February 1989"), "GPL-2.0": ("General", "2", "June 1991"), "GPL-3.0": ("General", "3", "29 June 2007"),
    "LGPL-2.0": ("Library General", "2", "June 1991"), "LGPL-2.1": ("Lesser General", "2.1", "February 1999"),
    "LGPL-3.0": ("Lesser General", "3", "29 June 2007"), "AGPL-3.0": ("Affero General", "3", "19 November 2007"),
}
_CC = {
    "CC-BY-4.0": "Attribution", "CC-BY-SA-4.0": "Attribution-ShareAlike", "CC-BY-ND-4.0": "Attribution-NoDerivatives",
    "CC-BY-NC-4.0": "Attribution-NonCommercial", "CC-BY-NC-SA-4.0": "Attribution-NonCommercial-ShareAlike",
    "CC-BY-NC-ND-4.0": "Attribution-NonCommercial-NoDerivatives",
}
_MPL = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. "
    "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
)
_APACHE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
    '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific '
    "language governing permissions and limitations under the License.",
)
TEXTS = Path(__file__).parent / "texts"


def all_templates() -> dict[str, list[str]]:
    """Notices, usual headers, titles, SPDX lines and full texts of each licence."""
    out = defaultdict(list, {name: [text] for name, text in TEMPLATES.items()})
    for name, (kind, version, date) in _GNU.items():
        title = f"GNU {kind} Public License"
        thing = "library" if name.startswith("L") else "program"
        for what in ("work", thing):
            out[name].append(f"This {what} is licensed under the {title}, version {version}.")
        free = f"This {thing} is free software; you can redistribute it and/or modify it under the terms of the {title} as published by the Free Software Foundation"
        out[name] += [f"{free}; either version {version} of the License, or (at your option) any later version.", f"{free}; version {version}.", f"{title} Version {version}, {date}"]
        out[name] += [f"SPDX-License-Identifier: {name}{x}" for x in ("", "-only", "-or-later")]
    for name, kind in _CC.items():
        short = name.replace("CC-BY", "CC BY").replace("-4.0", " 4.0")
        out[name] += [f"Licensed under {short}.", f"Creative Commons {kind} 4.0 International Public License", f"{kind} 4.0 International"]
        out[name].append(f"This work is licensed under a Creative Commons {kind} 4.0 International License.")
    out["Apache-2.0"] += [_APACHE[0], " ".join(_APACHE[:2]), " ".join(_APACHE), "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"]
    out["MPL-2.0"].append(_MPL)
    for name in ("BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause"):
        out[name].append(f"Released under the {name.replace('-', ' ', 1)} License.")
    for path in sorted(TEXTS.glob("*.txt")):
        out[path.stem].append(path.read_text(encoding="utf-8"))
    for name in out:
        if name not in _GNU:
            out[name].append(f"SPDX-License-Identifier: {name}")
    return {name: list(dict.fromkeys(texts)) for name, texts in out.items()}


MIN_SIMILARITY = 0.8
_ROUNDED = 1e-6  # similarities are rounded to six places before they meet the bound
# An identifier is one term: the rest of its line says nothing about another licence.
_SPDX = r"(?i)SPDX-License-Identifier:[ \t]*"
_SPDX_TERM = "spdx-license-identifier-"
_PARAGRAPH = r"\n[^\p{L}\p{N}]*\n"
_SENTENCE = r"(?<=[.;!?])\s+(?=[^\p{L}\p{N}]*\p{Lu})"
_CODE_LINE = r"(?md)^(?![ \t]*+(?:#|//|/?\*|--|;|%|!|<!--|\.\.|dnl\b|rem\b|REM\b))[^\n]*+$"
_BLOCK_COMMENT = r"(?s)/\*.*?\*/|<!--.*?-->|\"{3}.*?\"{3}|'{3}.*?'{3}"
TERM = r"[\p{L}\p{N}]+(?:[.+-][\p{L}\p{N}]+)*"
LICENSE_FILE = r"(?i)^(licen[cs]e|copying|unlicense)([.-].*)?$"
_OUTPUTS = ("license", "how", "similarity", "directory")
_TEMPORARY = ("_q_digest", "_q_text", "_q_path", "_q_speaks", "_q_dir")


def _terms(text: str) -> list[str]:
    return re.findall(TERM.replace(r"\p{L}\p{N}", r"^\W_"), re.sub(_SPDX, _SPDX_TERM, text).lower())


def _any(words: set[str]) -> str:
    """A pattern of the words in which common beginnings are tried once."""
    rest: dict[str, set[str]] = defaultdict(set)
    for word in words - {""}:
        rest[word[0]].add(word[1:])
    if not rest:
        return ""
    return "(?:" + "|".join(re.escape(x) + _any(ends) for x, ends in sorted(rest.items())) + ")" + ("?" if "" in words else "")


def _frequencies(files: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n): files that hold each of the distinct terms."""
    words = files.select(F.explode(F.array_distinct(_words("_q_text"))).alias("term"))
    counted = F.count("*").alias("n")
    if terms.count() <= BROADCAST_ROWS:
        return words.join(F.broadcast(terms), "term", "left_semi").groupBy("term").agg(counted)
    # Partial sums move, not words.
    return words.groupBy("term").agg(counted).join(terms, "term", "left_semi")


def _words(column: str) -> Column:
    return F.regexp_extract_all(F.lower(column), F.lit(TERM), 0)


def _vectors(templates: dict[str, str], idf: dict[str, float]) -> dict[str, dict[str, float]]:
    """Unit vectors of the templates."""
    out = {}
    for name, text in templates.items():
        weights = {t: n * idf[t] for t, n in Counter(_terms(text)).items()}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        out[name] = {t: w / norm for t, w in weights.items()}
    return out


def _essential(vectors: dict[str, dict[str, float]], bound: float, found: dict[str, int]) -> set[str]:
    """Terms one of which every unit must hold that reaches the bound with any template; those that few files hold."""
    out = set()
    for weights in vectors.values():
        rest = 1.0
        for term, w in sorted(weights.items(), key=lambda x: (-x[1] * x[1] / (1 + found.get(x[0], 0)), x[0])):
            if rest < bound * bound * (1 - 1e-9):
                break
            out.add(term)
            rest -= w * w
    return out


def _units(some: str) -> Column:
    """Units of _q_text, each once, that hold an essential term: the whole, number 0, then lines, then what spans or divides them."""
    lines = F.split("_q_text", "\n")
    paragraphs = F.split("_q_text", _PARAGRAPH)
    sentences = F.flatten(F.transform(F.filter(paragraphs, lambda x: x.rlike(some)), lambda x: F.split(x, _SENTENCE)))
    runs = F.split(F.regexp_replace("_q_text", _CODE_LINE, "\0"), "\0[\n\0]*")
    comments = F.regexp_extract_all("_q_text", F.lit(_BLOCK_COMMENT), F.lit(0))
    blocks = F.filter(F.array_distinct(F.concat(paragraphs, sentences, runs, comments)), lambda x: x.rlike(some) & (x != F.col("_q_text")))
    numbered = F.transform(lines, lambda x, k: F.struct((k + 1).alias("line"), x.alias("text")))
    more = F.transform(F.array_except(blocks, lines), lambda x, k: F.struct((k + 1 + F.size(lines)).alias("line"), x.alias("text")))
    whole = F.array(F.struct(F.lit(0).alias("line"), F.col("_q_text").alias("text")))
    return F.concat(whole, F.filter(numbered, lambda x: x["text"].rlike(some)), more)


def _counted(units: DataFrame) -> DataFrame:
    """(_q_digest, line, term, tf) of units (_q_digest, u)."""
    words = units.select("_q_digest", "u.line", F.explode(_words("u.text")).alias("term"))
    return words.groupBy("_q_digest", "line", "term").agg(F.count("*").alias("tf"))


def own_licenses(files: DataFrame, templates: dict[str, str | list[str]], min_similarity: float) -> DataFrame:
    """(_q_digest, license, how, similarity) of the texts of files (_q_digest, _q_text) that state a licence."""
    spark = files.sparkSession
    files = files.withColumn("_q_text", F.regexp_replace("_q_text", _SPDX, _SPDX_TERM))
    texts = {name: [x] if isinstance(x, str) else x for name, x in templates.items()}
    templates = {f"{name}\n{k}": x for name, several in texts.items() for k, x in enumerate(several)}
    terms = sorted({t for text in templates.values() for t in _terms(text)})
    listed = spark.createDataFrame([(t,) for t in terms], "term string")
    total = files.count()
    found = {r.term: r.n for r in _frequencies(files, listed).collect()}
    idf = {t: math.log((1 + total) / (1 + found.get(t, 0))) + 1 for t in terms}
    vectors = _vectors(templates, idf)
    some = "(?i)(?<![\\p{L}\\p{N}])" + _any(_essential(vectors, min_similarity - _ROUNDED, found)) + "(?![\\p{L}\\p{N}])"
    by_term: dict[str, dict[str, float]] = defaultdict(dict)
    for name, weights in vectors.items():
        for term, w in weights.items():
            by_term[term][name] = w
    weights = F.broadcast(spark.createDataFrame([(t, idf[t], by_term[t]) for t in terms], "term string, idf double, templates map<string,double>"))
    # Copies of a text are one; they are aggregated before they move.
    hit = files.where(F.col("_q_text").rlike(some)).groupBy("_q_digest").agg(F.first("_q_text").alias("_q_text"))
    units = hit.select("_q_digest", F.explode(_units(some)).alias("u"))
    counted = _counted(units).join(weights, "term", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(1.0)))
    square = F.sum(F.col("w") * F.col("w"))
    norms = counted.groupBy("_q_digest", "line").agg(square.alias("least"), F.coalesce(F.sum(F.when(F.col("idf").isNotNull(), F.col("w") * F.col("w"))), F.lit(0.0)).alias("known"))
    dots = counted.where("templates is not null").select("_q_digest", "line", "w", F.explode("templates").alias("license", "v"))
    dots = dots.groupBy("_q_digest", "line", "license").agg(F.sum(F.col("w") * F.col("v")).alias("dot"))
    near = dots.join(norms, ["_q_digest", "line"]).where(F.col("dot") / F.sqrt("least") >= min_similarity - _ROUNDED)
    near = written(near.select("_q_digest", "line", F.substring_index("license", "\n", 1).alias("license"), "dot", "known"), "near")
    left = units.join(broadcast_if_small(near.select("_q_digest", F.col("line").alias("_q_line")).distinct()), "_q_digest").where("u.line = _q_line")
    others = written(_counted(left.select("_q_digest", "u")).join(F.broadcast(listed), "term", "left_anti"), "others")
    held = written(_frequencies(files, others.select("term").distinct()), "frequencies")
    squares = others.join(broadcast_if_small(held), "term").withColumn("w", F.col("tf") * (F.log((1 + F.lit(total)) / (1 + F.col("n"))) + 1))
    squares = squares.groupBy("_q_digest", "line").agg(square.alias("unknown"))
    norm = F.sqrt(F.col("known") + F.coalesce("unknown", F.lit(0.0)))
    cosine = near.join(squares, ["_q_digest", "line"], "left").select("_q_digest", "line", "license", F.round(F.col("dot") / norm, 6).alias("similarity"))
    best = F.max(F.struct("similarity", (-F.col("line")).alias("l"), F.col("license"))).alias("x")
    least = cosine.where(F.col("similarity") >= min_similarity)
    # Of equally good ones the first line, then the first template by name.
    first = least.groupBy("_q_digest", "line", "similarity").agg(F.min("license").alias("license"))
    chosen = first.groupBy("_q_digest").agg(best)
    return chosen.select("_q_digest", "x.license", F.when(F.col("x.l") == 0, "file").otherwise("header").alias("how"), "x.similarity")


def _ancestors(path: Column) -> Column:
    """All directories above a path, the nearest first; the root is ''."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.size(parts) - 1, F.lit(0), F.lit(-1)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))


def scan_licenses(
    files: DataFrame, *, path: str = "path", text: str = "text", speaks: Column | None = None,
    templates: dict[str, str | list[str]] | None = None, min_similarity: float = MIN_SIMILARITY, carry: list[str] | None = None,
) -> DataFrame:
    """The columns `carry` (default: all) of files with license, how (header, file or inherited), similarity, directory.

    templates has a text or several for each licence (default: `all_templates`); directory is the one a licence was inherited from. `speaks` tells which files speak for their directory.
    """
    base = without(files, (*_OUTPUTS, *_TEMPORARY))
    carry = base.columns if carry is None else carry
    named = F.regexp_extract(F.col(path), "[^/]*$", 0).rlike(LICENSE_FILE)
    slim = base.select(
        *carry, F.unhex(F.md5(F.col(text).cast("binary"))).alias("_q_digest"), F.col(text).alias("_q_text"), F.col(path).alias("_q_path"),
        F.coalesce(named if speaks is None else speaks, F.lit(False)).alias("_q_speaks"),
    )
    own = written(own_licenses(slim.select("_q_digest", "_q_text"), all_templates() if templates is None else templates, min_similarity), "licenses")
    rows = slim.drop("_q_text").withColumn("_q_dir", F.element_at(_ancestors(F.col("_q_path")), 1))
    judged = written(rows.join(broadcast_if_small(own), "_q_digest", "left"), "judged")
    said = judged.where("_q_speaks and license is not null and _q_dir is not null").groupBy("_q_dir", "license").agg(F.count("*").alias("n"))
    spoken = said.groupBy(F.col("_q_dir").alias("directory")).agg(F.max(F.struct("n", "license")).alias("x"))
    top = said.join(spoken.select(F.col("directory").alias("_q_dir"), F.col("x.n").alias("n")), ["_q_dir", "n"])
    spoken = top.groupBy(F.col("_q_dir").alias("directory")).agg(F.min("license").alias("inherited"))
    places = judged.where("license is null and _q_dir is not null").select("_q_dir").distinct()
    above = places.select("_q_dir", F.posexplode(F.concat(F.array("_q_dir"), F.when(F.col("_q_dir") == "", F.array().cast("array<string>")).otherwise(_ancestors(F.col("_q_dir"))))).alias("up", "directory"))
    nearest = above.join(spoken, "directory").groupBy("_q_dir").agg(F.min(F.struct("up", "directory", "inherited")).alias("x"))
    nearest = broadcast_if_small(written(nearest.select("_q_dir", "x.directory", "x.inherited"), "directories"))
    out = judged.join(nearest, "_q_dir", "left")
    mine = F.col("license").isNotNull()
    return out.select(
        *carry,
        F.coalesce("license", "inherited").alias("license"),
        F.when(mine, F.col("how")).when(F.col("inherited").isNotNull(), "inherited").alias("how"),
        "similarity",
        F.when(~mine, F.col("directory")).alias("directory"),
    )
