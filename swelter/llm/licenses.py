"""Licence scan with ordered signature rules, in Spark functions only.

Each rule has a priority, a label, a keyword (or several, one of which every match holds as a word) and a hand-written regex. One pass over the text collects the keywords that
occur; only the rules of those keywords run. Of overlapping detections, one that lies inside another of the same or a
better priority is suppressed (for equal spans the earlier rule stands). The rest give the labels and the score, the
weight of the best priority among them.

Beside the rules stand three base phrases, counted at every place where their words stand consecutively.

Null and empty texts have no words, places or labels and score 0. Each row is decided by itself, so repeated rows, null ids
and extra columns change nothing, and no text is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Score of a detection by priority, and of base phrases alone.
WEIGHTS, BASE_WEIGHT = (1.0, 0.95, 0.8, 0.5), 0.4

# Names and versions of licences.
SPDX_IDS = """
0BSD AFL-2.1 AFL-3.0 AGPL-1.0 AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.0 Apache-1.1 Apache-2.0 APSL-2.0 Artistic-1.0
Artistic-2.0 BlueOak-1.0.0 BSD-1-Clause BSD-2-Clause BSD-2-Clause-Patent BSD-3-Clause BSD-3-Clause-Clear BSD-4-Clause BSL-1.0 BUSL-1.1
CC-BY-1.0 CC-BY-2.0 CC-BY-2.5 CC-BY-3.0 CC-BY-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC-BY-NC-3.0 CC-BY-NC-4.0 CC-BY-ND-4.0 CC-BY-NC-SA-4.0
CC-BY-NC-ND-4.0 CC0-1.0 CDDL-1.0 CDDL-1.1 CECILL-2.1 CPAL-1.0 CPL-1.0 ECL-2.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2 FTL GFDL-1.2
GFDL-1.3 GPL-1.0 GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0 GPL-3.0-only GPL-3.0-or-later ISC IPL-1.0 LGPL-2.0 LGPL-2.1 LGPL-2.1-only
LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later LPPL-1.3c MIT MIT-0 MPL-1.1 MPL-2.0 MS-PL MS-RL MulanPSL-2.0 NCSA ODbL-1.0
OFL-1.1 OpenSSL OSL-3.0 PDDL-1.0 PHP-3.01 PostgreSQL PSF-2.0 Python-2.0 QPL-1.0 Ruby SSPL-1.0 Sleepycat Unlicense UPL-1.0 Vim W3C WTFPL
X11 Zend-2.0 Zlib ZPL-2.1
""".split()

#: label stem | keyword | full name, as a regex | versions
FAMILIES = """
gpl | gpl | GNU\\s+General\\s+Public\\s+Licen[sc]e | 1.0 2.0 3.0
gpl | gnu | GPL | 1.0 2.0 3.0
lgpl | gnu | GNU\\s+(?:Lesser|Library)\\s+General\\s+Public\\s+Licen[sc]e | 2.0 2.1 3.0
lgpl | lgpl | LGPL | 2.0 2.1 3.0
agpl | gnu | GNU\\s+Affero\\s+General\\s+Public\\s+Licen[sc]e | 1.0 3.0
agpl | agpl | AGPL | 1.0 3.0
gfdl | gnu | GNU\\s+Free\\s+Documentation\\s+Licen[sc]e | 1.1 1.2 1.3
apache | apache | Apache\\s+(?:Software\\s+)?Licen[sc]e | 1.0 1.1 2.0
mpl | mozilla | Mozilla\\s+Public\\s+Licen[sc]e | 1.0 1.1 2.0
mpl | mpl | MPL | 1.0 1.1 2.0
epl | eclipse | Eclipse\\s+Public\\s+Licen[sc]e | 1.0 2.0
cddl | development | Common\\s+Development\\s+and\\s+Distribution\\s+Licen[sc]e | 1.0 1.1
cpl | common | Common\\s+Public\\s+Licen[sc]e | 0.5 1.0
eupl | union | European\\s+Union\\s+Public\\s+Licen[sc]e | 1.0 1.1 1.2
artistic | artistic | Artistic\\s+Licen[sc]e | 1.0 2.0
afl | academic | Academic\\s+Free\\s+Licen[sc]e | 1.2 2.0 2.1 3.0
osl | open | Open\\s+Software\\s+Licen[sc]e | 1.0 2.0 2.1 3.0
ofl | font | SIL\\s+Open\\s+Font\\s+Licen[sc]e | 1.0 1.1
boost | boost | Boost\\s+Software\\s+Licen[sc]e | 1.0
psf | python | Python\\s+Software\\s+Foundation\\s+Licen[sc]e | 2.0
php | php | PHP\\s+Licen[sc]e | 3.0 3.01
zpl | zope | Zope\\s+Public\\s+Licen[sc]e | 1.1 2.0 2.1
lppl | latex | LaTeX\\s+Project\\s+Public\\s+Licen[sc]e | 1.0 1.1 1.2 1.3
cecill | cecill | CeCILL(?:\\s+Free\\s+Software)?(?:\\s+Licen[sc]e)? | 1.0 2.0 2.1
odbl | database | Open\\s+Database\\s+Licen[sc]e | 1.0
busl | business | Business\\s+Source\\s+Licen[sc]e | 1.0 1.1
sspl | server | Server\\s+Side\\s+Public\\s+Licen[sc]e | 1.0
""".strip().splitlines()

CC_PARTS = {
    "by": "Attribution",
    "by-sa": "Attribution[\\s-]+Share\\s?Alike",
    "by-nd": "Attribution[\\s-]+No\\s?Deriv(?:ative)?s?",
    "by-nc": "Attribution[\\s-]+Non\\s?-?Commercial",
    "by-nc-sa": "Attribution[\\s-]+Non\\s?-?Commercial[\\s-]+Share\\s?Alike",
    "by-nc-nd": "Attribution[\\s-]+Non\\s?-?Commercial[\\s-]+No\\s?Deriv(?:ative)?s?",
}
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")

#: priority | label | keyword | regex
NAMED = """
3 | mit | licen | (?:the\\s+)?MIT(?:\\s+|-)(?:Open\\s+Source\\s+)?Licen[sc]ed?
2 | mit | permission | Permission\\s+is\\s+hereby\\s+granted,?\\s+free\\s+of\\s+charge,?\\s+to\\s+any\\s+person
2 | isc | permission | Permission\\s+to\\s+use,\\s+copy,\\s+modify,\\s+and(?:/or)?\\s+distribute\\s+this\\s+software
2 | bsd-2-clause | bsd | (?:simplified|two|2)[\\s-]+(?:clause\\s+)?BSD(?:\\s+licen[sc]e)?
2 | bsd-3-clause | bsd | (?:new|modified|revised|three|3)[\\s-]+(?:clause\\s+)?BSD(?:\\s+licen[sc]e)?
2 | bsd-4-clause | bsd | (?:original|four|4)[\\s-]+(?:clause\\s+)?BSD(?:\\s+licen[sc]e)?
2 | bsd-2-clause | bsd | BSD[\\s-]+2[\\s-]+Clause
2 | bsd-3-clause | bsd | BSD[\\s-]+3[\\s-]+Clause
2 | bsd | redistribution | Redistribution\\s+and\\s+use\\s+in\\s+source\\s+and\\s+binary\\s+forms
3 | bsd | bsd | BSD(?:[\\s-]+style)?\\s+licen[sc]ed?
3 | isc | licen | ISC\\s+licen[sc]ed?
3 | zlib | licen | zlib(?:/libpng)?\\s+licen[sc]e
3 | openssl | openssl | OpenSSL\\s+licen[sc]e
3 | ncsa | licen | (?:University\\s+of\\s+Illinois/)?NCSA\\s+(?:Open\\s+Source\\s+)?licen[sc]e
3 | postgresql | postgresql | PostgreSQL\\s+licen[sc]e
3 | vim | licen | Vim\\s+licen[sc]e
3 | ruby | licen | Ruby(?:'s)?\\s+licen[sc]e
3 | x11 | licen | X11\\s+licen[sc]e
3 | wtfpl | wtfpl fuck | WTFPL|Do\\s+What\\s+the\\s+Fuck\\s+You\\s+Want\\s+to\\s+Public\\s+Licen[sc]e
3 | unlicense | unlicense | (?:the\\s+)?Unlicense
3 | cc0 | cc0 | CC0(?:\\s+1\\.0)?(?:\\s+Universal)?
3 | cc | creative | Creative\\s+Commons(?:\\s+licen[sc]e)?
3 | ms-pl | microsoft | Microsoft\\s+Public\\s+Licen[sc]e
3 | ms-rl | microsoft | Microsoft\\s+Reciprocal\\s+Licen[sc]e
3 | upl | universal | Universal\\s+Permissive\\s+Licen[sc]e
3 | ecl | educational | Educational\\s+Community\\s+Licen[sc]e
3 | beerware | beer | Beer-?ware(?:\\s+licen[sc]e)?
3 | mulan | mulan | Mulan\\s+(?:PSL|Permissive\\s+Software\\s+Licen[sc]e)
3 | blueoak | model | Blue\\s+Oak\\s+Model\\s+Licen[sc]e
3 | commons-clause | clause | Commons\\s+Clause
3 | openrail | openrail | Open\\s?RAIL(?:-[MS]+)?(?:\\s+licen[sc]e)?
3 | public-domain | domain | (?:released\\s+|placed\\s+|dedicated\\s+)?(?:in|into|to)\\s+the\\s+public\\s+domain
3 | perl | perl | same\\s+terms\\s+as\\s+Perl(?:\\s+itself)?
4 | public-domain | domain | public\\s+domain
4 | copyright | copyright | copyright\\s+(?:\\(c\\)|©)?\\s*(?:19|20)\\d\\d(?:\\s*[-–,]\\s*(?:19|20)?\\d\\d)*
4 | copyright | copyright ©copyright | (?:\\(c\\)|©)\\s*copyright
4 | reserved | reserved | (?:all|some|no)\\s+rights\\s+reserved
4 | proprietary | proprietary | proprietary(?:\\s+and\\s+confidential)?(?:\\s+(?:software|information|licen[sc]e))
4 | no-warranty | warrant | (?:without|no)\\s+warranty\\s+of\\s+any\\s+kind
4 | no-warranty | warrant | provided\\s+"?as[\\s-]is"?,?\\s+without\\s+(?:any\\s+)?(?:express\\s+or\\s+implied\\s+)?warrant(?:y|ies)
4 | licensed | under | (?:is\\s+|are\\s+)?(?:licen[sc]ed|released|distributed|available)\\s+under(?:\\s+the)?(?:\\s+terms\\s+of(?:\\s+the)?)?
4 | license-file | licen | see\\s+(?:the\\s+)?(?:accompanying\\s+)?LICEN[SC]E(?:\\s+file|\\.txt|\\.md)
4 | commercial | commercial noncommercial | (?:not\\s+for\\s+|no\\s+|non-?)commercial\\s+use
4 | no-ai | train training | may\\s+not\\s+be\\s+used\\s+(?:for|to)\\s+train(?:ing)?
4 | permission | permission | (?:used|reprinted|reproduced)\\s+(?:with|by)\\s+permission
4 | trademark | trademark | (?:registered\\s+)?trademarks?\\s+of
""".strip().splitlines()

#: Base phrases (fixed values): words and label.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

_LETTER = "0-9A-Za-z\\x{80}-\\x{10FFFF}"
WORD = f"[{_LETTER}]+"


def _version(v: str) -> str:
    major, minor = v.split(".", 1)
    return f"{major}(?:\\.{minor})?" if minor == "0" else f"{major}\\.{minor}"


def _bounded(regex: str) -> str:
    return f"(?i)(?<![{_LETTER}])(?:{regex})(?![{_LETTER}])"


def rules() -> list[tuple[int, str, str, str]]:
    """Every rule in order: priority, label, keyword, regex."""
    out = [(1, i.lower(), "spdx", f"SPDX-License-Identifier:\\s*{i.replace('.', '\\.')}(?![.\\w+-]*\\w)") for i in SPDX_IDS]
    for line in FAMILIES:
        stem, keyword, name, versions = (x.strip() for x in line.split(" | "))
        keyword = "gnu" if keyword == "gpl" else "gpl" if name == "GPL" else keyword
        gap = ",?\\s*-?\\(?(?:version\\s*|v\\.?\\s*)?" if not name.isupper() else "[\\s,-]*(?:version\\s*|v\\.?\\s*)?"
        for v in versions.split():
            out.append((2, f"{stem}-{v}-or-later", keyword, f"{name}{gap}{_version(v)}\\)?,?(?:\\s+\\(?or\\s+(?:\\(?at\\s+your\\s+option\\)?\\s+)?(?:any\\s+)?(?:later|newer|above)(?:\\s+version)?|\\+)"))
            out.append((2, f"{stem}-{v}", keyword, f"{name}{gap}{_version(v)}"))
        out.append((3, stem, keyword, name))
    for part, name in CC_PARTS.items():
        short = part.replace("-", "[\\s-]+")
        for v in CC_VERSIONS:
            out.append((2, f"cc-{part}-{v}", "cc", f"CC[\\s-]+{short}[\\s,-]*(?:v\\.?\\s*)?{_version(v)}"))
            out.append((2, f"cc-{part}-{v}", "creative", f"Creative\\s+Commons\\s+{name}(?:\\s+(?:Licen[sc]e|International|Unported|Generic))*[\\s,]*(?:version\\s+)?{_version(v)}"))
        out.append((3, f"cc-{part}", "cc", f"CC[\\s-]+{short}"))
        out.append((3, f"cc-{part}", "creative", f"Creative\\s+Commons\\s+{name}"))
    for line in NAMED:
        priority, label, keyword, regex = (x.strip() for x in line.split(" | ", 3))
        out.append((int(priority), label, keyword, regex))
    return [(p, label, keyword, _bounded(regex)) for p, label, keyword, regex in out]


def _spellings(keyword: str) -> list[str]:
    """The lower-cased words that stand for a keyword."""
    stems = {"licen": "license licence licensed licenced licenses licences licensing", "warrant": "warranty warranties warrants", "trademark": "trademark trademarks", "openrail": "openrail rail", "zope": "zope", "beer": "beer beerware", "cc": "cc", "mulan": "mulan", "redistribution": "redistribution"}
    if keyword in ("gpl", "lgpl", "agpl", "mpl", "cecill"):
        return [f"{keyword}{v}{n}" for v in ("", "v", "version") for n in ("", 1, 2, 3)]
    return stems.get(keyword, keyword).split()


def _places(text: Column, phrase: str) -> Column:
    """Number of places of a phrase, and the number of words before the first and after the last."""
    words = phrase.split()
    parts = F.split(text, _bounded(f"[^{_LETTER}]+".join(words)))
    return F.struct((F.size(parts) - 1).cast("long").alias("n"), F.regexp_count(F.element_at(parts, 1), F.lit(WORD)).alias("before"), (F.regexp_count(F.element_at(parts, -1), F.lit(WORD)) + len(words)).alias("after"))


def scan(docs: DataFrame) -> DataFrame:
    """One row per document row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    table = rules()
    priorities, labels, keywords, regexes = (F.lit(list(x)) for x in zip(*table, strict=True))
    text = F.col("text")

    def spans(i: Column) -> Column:
        """Start and end of the matches of rule i."""
        regex = F.element_at(regexes, i)
        sizes = F.arrays_zip(F.transform(F.split(text, regex), F.length).alias("gap"), F.transform(F.regexp_extract_all(text, regex, F.lit(0)), F.length).alias("hit"))
        none = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int>>").alias("out"))

        def step(acc, x):
            s = acc["at"] + x["gap"]
            e = s + F.coalesce(x["hit"], F.lit(0))
            return F.struct(e.alias("at"), F.when(x["hit"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(F.struct(s.alias("s"), e.alias("e"))))).alias("out"))

        return F.aggregate(sizes, none, step, lambda acc: acc["out"])

    chosen = F.filter(F.sequence(F.lit(1), F.lit(len(table))), lambda i: F.array_contains(F.col("found"), F.element_at(keywords, i)))
    hits = F.array_sort(F.flatten(F.transform(chosen, lambda i: F.transform(spans(i), lambda x: F.struct(x["s"].alias("s"), (-x["e"]).alias("e"), F.element_at(priorities, i).alias("p"), i.alias("i"))))))
    start = F.struct(F.array_repeat(F.lit(0), 4).alias("reach"), F.array().cast("array<string>").alias("labels"), F.lit(9).alias("best"))

    def settle(acc, h):
        """Hits come by start, longest first: one is inside an earlier hit when that reaches its end."""
        inside = F.element_at(acc["reach"], h["p"]) >= -h["e"]
        reach = F.transform(acc["reach"], lambda r, k: F.when(k + 1 >= h["p"], F.greatest(r, -h["e"])).otherwise(r))
        return F.struct(reach.alias("reach"), F.when(inside, acc["labels"]).otherwise(F.array_union(acc["labels"], F.array(F.element_at(labels, h["i"])))).alias("labels"), F.when(inside, acc["best"]).otherwise(F.least(acc["best"], h["p"])).alias("best"))

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # inline() keeps these columns from being computed again for each use above them
    spelled = {k: _spellings(k) for k in sorted({r[2] for r in table} | {"general", "reserved"})}
    out = out.select("doc_id", "text", F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)).alias("words"))
    seen = F.array_intersect("words", F.lit(sorted({w for ws in spelled.values() for w in ws})))
    out = out.select("doc_id", "text", F.inline(F.array(F.struct(F.size("words").cast("long").alias("n_words"), seen.alias("seen")))))
    found = F.array_compact(F.array(*(F.when(F.arrays_overlap("seen", F.lit(ws)), F.lit(k)) for k, ws in spelled.items())))
    out = out.select("doc_id", "text", "n_words", F.inline(F.array(F.struct(F.when(F.size("seen") > 0, found).otherwise(F.array().cast("array<string>")).alias("found")))))
    rare = {"cc by": "cc", "general public license": "general", "all rights reserved": "reserved"}
    places = [F.when(F.array_contains("found", rare[p]), _places(text, p)).alias(f"b{k}") for k, (p, _) in enumerate(PHRASES)]
    kept = F.when(F.size("found") > 0, F.aggregate(hits, start, settle)).alias("kept")
    out = out.select("doc_id", "n_words", F.inline(F.array(F.struct(*places, kept))))
    some = [F.col(f"b{k}.n") > 0 for k in range(len(PHRASES))]
    base = F.array_compact(F.array(*(F.when(s, F.lit(label)) for s, (_, label) in zip(some, PHRASES, strict=True))))
    first = F.array_min(F.array(*(F.when(s, F.col(f"b{k}.before")) for k, s in enumerate(some)))).cast("long")
    last = F.array_max(F.array(*(F.when(s, F.col("n_words") - F.col(f"b{k}.after")) for k, s in enumerate(some)))).cast("long")
    own = F.coalesce(F.col("kept.labels"), F.array().cast("array<string>"))
    weight = F.when(F.size(base) > 0, BASE_WEIGHT).otherwise(0.0)
    for k, w in reversed(list(enumerate(WEIGHTS, 1))):
        weight = F.when(F.col("kept.best") == k, w).otherwise(weight)
    return out.select(
        "doc_id",
        "n_words",
        sum((F.coalesce(F.col(f"b{k}.n"), F.lit(0)) for k in range(len(PHRASES))), F.lit(0)).cast("long").alias("n_base"),
        first.alias("first_word"),
        last.alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, own)), ",").alias("labels"),
        weight.cast("double").alias("score"),
    )
