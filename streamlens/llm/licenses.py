"""License scan by ordered signature rules, in DataFrame expressions only.

Base: the places where a fixed phrase's words stand consecutively.  The method
adds detections by regular expressions.  A rule is tried only on texts that
hold its keyword; of overlapping detections, one that lies inside another of
the same or a higher priority is suppressed (of equal spans and priorities the
first rule stays).

Defined results: a null or empty text has no words and no detections; a text
with the same doc_id as another is judged alone; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases and their labels.
BASE_PHRASES = {
    "general": ("gnu general public license", "gpl"),
    "apache": ("apache license", "apache"),
    "cc": ("cc by", "cc-by"),
    "mit": ("mit license", "mit"),
}

# A word is a run of ASCII letters, digits and anything beyond ASCII.  The others are listed one
# by one: Java looks single characters up in a table and tries ranges in turn, which is far slower.
_OTHERS = "".join(rf"\x{code:02X}" for code in range(128) if not chr(code).isalnum())
_WORD, _GAP = f"[^{_OTHERS}]+", f"[{_OTHERS}]+"
_BEFORE, _AFTER = rf"(?<!{_WORD[:-1]})", rf"(?!{_WORD[:-1]})"


@dataclass(frozen=True)
class Rule:
    """``pattern`` is tried where all words of ``keyword`` (lower case) occur; the larger
    priority wins.

    The words of ``gate`` occur wherever the pattern can match, too; many rules share
    one, so that few are looked for in every text.  So does ``stem``, a pattern that is
    looked for once for all rules with the same keyword and stem.
    """

    label: str
    keyword: str
    pattern: str
    priority: int
    gate: str = ""
    stem: str = ""


# License families, names as they are written, and versions.
FAMILIES = (
    ("gpl", "gnu general public licen[cs]e", "general public", ("1.0", "2.0", "3.0")),
    ("lgpl", "gnu (?:lesser|library) general public licen[cs]e", "general public", ("2.0", "2.1", "3.0")),
    ("agpl", "(?:gnu )?affero general public licen[cs]e", "affero", ("1.0", "3.0")),
    ("gfdl", "gnu free documentation licen[cs]e", "free documentation", ("1.1", "1.2", "1.3")),
    ("apache", "apache (?:software )?licen[cs]e", "apache", ("1.0", "1.1", "2.0")),
    ("mpl", "mozilla public licen[cs]e", "mozilla", ("1.0", "1.1", "2.0")),
    ("epl", "eclipse public licen[cs]e", "eclipse", ("1.0", "2.0")),
    ("cddl", "common development and distribution licen[cs]e", "common development", ("1.0", "1.1")),
    ("cpl", "common public licen[cs]e", "common public", ("1.0",)),
    ("eupl", "european union public licen[cs]e", "european union", ("1.0", "1.1", "1.2")),
    ("artistic", "artistic licen[cs]e", "artistic", ("1.0", "2.0")),
    ("bsl", "boost software licen[cs]e", "boost", ("1.0",)),
    ("osl", "open software licen[cs]e", "open software", ("1.0", "2.0", "2.1", "3.0")),
    ("afl", "academic free licen[cs]e", "academic free", ("1.1", "1.2", "2.0", "2.1", "3.0")),
    ("ofl", "(?:sil )?open font licen[cs]e", "open font", ("1.0", "1.1")),
    ("ms-pl", "microsoft public licen[cs]e", "microsoft", ()),
    ("ms-rl", "microsoft reciprocal licen[cs]e", "microsoft", ()),
    ("odbl", "open (?:data commons open )?database licen[cs]e", "database", ("1.0",)),
    ("cecill", "cecill(?:-[bc])?(?: free software)? licen[cs]e", "cecill", ("1.0", "2.0", "2.1")),
    ("zlib", "zlib licen[cs]e", "zlib", ()),
    ("isc", "isc licen[cs]e", "isc", ()),
    ("mit", "(?:mit|expat|x11) licen[cs]e", "licen", ()),
    ("unlicense", "the unlicense", "unlicense", ()),
    ("wtfpl", "do what the fuck you want to public licen[cs]e", "what the", ("1.0", "2.0")),
    ("psf", "python software foundation licen[cs]e", "python", ("2.0",)),
    ("php", "php licen[cs]e", "php", ("3.0", "3.01")),
    ("postgresql", "postgresql licen[cs]e", "postgresql", ()),
    ("qpl", "q public licen[cs]e", "public licen", ("1.0",)),
    ("vim", "vim licen[cs]e", "vim", ()),
    ("ncsa", "(?:university of illinois/?)?ncsa open source licen[cs]e", "ncsa", ()),
)
SHORT_NAMES = ("gpl", "lgpl", "agpl", "apache", "mpl", "epl", "cddl", "eupl")
BSD_CLAUSES = ("0", "1", "2", "3", "4")
CC_PARTS = ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd")
CC_NAMES = {
    "by": "attribution",
    "by-sa": "attribution-sharealike",
    "by-nd": "attribution-noderiv(?:ative)?s",
    "by-nc": "attribution-noncommercial",
    "by-nc-sa": "attribution-noncommercial-sharealike",
    "by-nc-nd": "attribution-noncommercial-noderiv(?:ative)?s",
}
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
GRANTS = (
    ("mit", "permission is hereby granted", "permission is hereby granted,? free of charge,? to any person obtaining a copy"),
    ("isc", "permission to use", "permission to use,? copy,? modify,? and/or distribute this software"),
    ("bsd", "redistribution and use", "redistribution and use in source and binary forms"),
    ("bsd", "neither the name", "neither the name of .{1,80}? nor the names of its contributors"),
    ("apache", "apache", "licensed under the apache licen[cs]e"),
    ("gpl", "free software", "you can redistribute it and/or modify it under the terms of the gnu general public"),
    ("lgpl", "free software", "you can redistribute it and/or modify it under the terms of the gnu (?:lesser|library) general"),
    ("mpl", "mozilla", "this source code form is subject to the terms of the mozilla public"),
    ("zlib", "as-is", "this software is provided ['\"]?as-is['\"]?,? without any express or implied"),
    ("unlicense", "public domain", "free and unencumbered software released into the public domain"),
    ("public-domain", "public domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("cc0", "cc0", "cc0(?: 1\\.0)?(?: universal)?"),
    ("cc0", "creative commons", "creative commons zero"),
    ("proprietary", "all rights reserved", "all rights reserved"),
    ("proprietary", "confidential", "confidential and proprietary"),
)


_SPDX = "spdx-license-identifier:"


def _spaced(pattern: str) -> str:
    return pattern.replace(" ", r"\s+")


def _version(number: str) -> str:
    major, _, minor = number.partition(".")
    return major + (rf"(?:\.{minor})?" if minor == "0" else rf"\.{minor}")


def rules() -> list[Rule]:
    """All signature rules, some hundreds, in the order of the tables above."""
    found: list[Rule] = []
    for label, name, keyword, versions in FAMILIES:
        found.append(Rule(label, keyword, name, 50, "licen", name))
        later = r",?(?: (?:as published by the free software foundation[;,]? )?(?:either )?(?:v|version )[0-9.]+[;,]?)? (?:or any|or \(at your option\) any) later version"
        found.append(Rule(f"{label}-or-later", keyword, name + later, 85, "licen", name))
        for version in versions:
            number = _version(version)
            found.append(Rule(f"{label}-{version}", keyword, rf"{name},? (?:v|version |v\. ?)?{number}", 80, "licen", name))
            found.append(Rule(f"{label}-{version}", "spdx", rf"spdx-license-identifier: ?{label}-{number}(?:-only|-or-later|\+)?", 95, stem=_SPDX))
            if label in SHORT_NAMES:
                found.append(Rule(f"{label}-{version}", label, rf"{label}[- ]?v?{number}", 60, stem=rf"{label}[- ]?v?[0-9]"))
        if not versions:
            found.append(Rule(label, "spdx", rf"spdx-license-identifier: ?{label}", 95, stem=_SPDX))
    for count in BSD_CLAUSES:
        found.append(Rule(f"bsd-{count}-clause", "bsd", rf"(?:bsd[- ]{count}[- ]clause|{count}[- ]clause bsd)(?: licen[cs]e)?", 80))
        found.append(Rule(f"bsd-{count}-clause", "spdx", rf"spdx-license-identifier: ?bsd-{count}-clause", 95, stem=_SPDX))
    found.append(Rule("bsd", "bsd", "(?:new |simplified |modified )?bsd(?:-style)? licen[cs]e", 50))
    for part in CC_PARTS:
        written = part.replace("-", "[- ]")
        found.append(Rule(f"cc-{part}", "cc by", rf"cc[- ]{written}", 40 + len(part), stem="cc[- ]by"))
        found.append(Rule(f"cc-{part}", "creative commons", rf"creative commons {CC_NAMES[part]}", 50 + len(part), stem="creative commons attribution"))
        for version in CC_VERSIONS:
            number = _version(version)
            found.append(Rule(f"cc-{part}-{version}", "cc by", rf"cc[- ]{written}[- ]{number}", 70 + len(part), stem="cc[- ]by"))
            found.append(Rule(f"cc-{part}-{version}", "creative commons", rf"creative commons {CC_NAMES[part]} {number}", 72 + len(part), stem="creative commons attribution"))
            found.append(Rule(f"cc-{part}-{version}", "creativecommons", rf"creativecommons\.org/licenses/{part}/{number}", 90, stem=r"creativecommons\.org/licenses/by"))
    for label, keyword, pattern in GRANTS:
        found.append(Rule(label, keyword, pattern, 65 if label != "proprietary" else 30))
    return found


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _rule_table() -> str:
    """The rules, in groups that are looked at together; a rule's number is its place among all."""
    groups: dict[tuple[str, str, str], list[str]] = {}
    for at, r in enumerate(rules()):
        groups.setdefault((r.gate, r.keyword, r.stem), []).append(
            f"named_struct('rule', {at}, 'label', {_quoted(r.label)}, 'priority', {r.priority},"
            f" 'pattern', {_quoted('(?is)' + _BEFORE + '(?:' + _spaced(r.pattern) + ')' + _AFTER)})"
        )
    rows = [
        f"named_struct('keywords', array({', '.join(map(_quoted, dict.fromkeys([*gate.split(), *keyword.split()])))}),"
        f" 'stem', {_quoted('(?is)' + _spaced(stem) if stem else '')}, 'rules', array({', '.join(own)}))"
        for (gate, keyword, stem), own in groups.items()
    ]
    return f"array({', '.join(rows)})"


# From the commonest to the rarest; a search stops at every place where the first letter stands.
_COMMON = "etaoinsrhldcumfpgwybvkxjqz"


def _rare_end(word: str) -> str:
    """The end of ``word`` that starts with its rarest letter, of three letters or more."""
    ends = [word[at:] for at in range(max(1, len(word) - 2))]
    return max(ends, key=lambda end: _COMMON.find(end[0]) % 100)


def _gates() -> list[list[str]]:
    """Words of which one list occurs, whole, in every text with a detection; long words, which are rarer, first.

    A list is left out if its words hold those of another one.
    """
    keys = sorted({r.gate or r.keyword for r in rules()})
    found = [sorted(key.split(), key=len, reverse=True) for key in keys]
    holds = lambda one, other: all(any(w in own for own in one) for w in other)
    return [
        one
        for at, one in enumerate(found)
        if not any(holds(one, other) and (not holds(other, one) or k < at) for k, other in enumerate(found) if k != at)
    ]


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Lists are gone through in pieces of this size, as appending to a list copies it: the work for
# n items grows with n * CHUNK + (n / CHUNK) ** 2 copied cells, not with n ** 2.
CHUNK = 64


def _chunks(items: str) -> str:
    last = f"cast(floor((size({items}) - 1) / {CHUNK}) AS int)"
    return f"transform(sequence(0, greatest({last}, 0)), c -> slice({items}, c * {CHUNK} + 1, {CHUNK}))"


def _named(value: str, name: str, use: str) -> str:
    """``use``, in which ``name`` is ``value``, computed once."""
    return f"transform(array({value}), {name} -> {use})[0]"


# Where a pattern matches: the lengths of what stands between and of the matches,
# summed up from the left; a span is (start, end) in characters.
_NO_SPANS = "cast(array() AS array<struct<start: int, end: int>>)"
_PIECES = """
filter(
  zip_with(split(__text, {p}, -1), matches,
           (gap, hit) -> struct(length(gap) AS gap, length(hit) AS hit)),
  x -> x.hit IS NOT NULL)
"""
_IN_CHUNK = f"""
aggregate(chunk, struct(0 AS at, {_NO_SPANS} AS spans), (acc, x) -> struct(
  acc.at + x.gap + x.hit AS at,
  concat(acc.spans, array(struct(
    acc.at + x.gap AS start, acc.at + x.gap + x.hit AS end))) AS spans))
"""
_JOINED = f"""
flatten(zip_with(
  locals,
  aggregate(locals, array(0), (acc, l) -> concat(acc, array(element_at(acc, -1) + l.at))),
  (l, o) -> CASE WHEN l IS NULL THEN {_NO_SPANS}
    ELSE transform(l.spans, s -> struct(s.start + o AS start, s.end + o AS end)) END))
"""


def _spans(pattern: str) -> str:
    within = f"transform({_chunks('pieces')}, chunk -> {_IN_CHUNK})"
    spans = _named(_PIECES.format(p=pattern), "pieces", _named(within, "locals", _JOINED))
    # Where nothing matches, which is the rule, the text is not split.
    found = f"CASE WHEN size(matches) = 0 THEN {_NO_SPANS} ELSE {spans} END"
    return _named(f"regexp_extract_all(__text, {pattern}, 0)", "matches", found)


# Per priority, the furthest end so far: a detection is inside an earlier one of at least its
# priority if that one reaches its end.  A chunk starts with the ends of all before it.
_NO_ENDS = "cast(map() AS map<int, int>)"
_DETECTIONS = "array<struct<label: string, priority: int, start: int, end: int>>"
_FURTHER = """map_concat(map_filter({ends}, (k, v) -> k <> x.priority),
  map(x.priority, greatest(x.end, coalesce({ends}[x.priority], 0))))"""
_ENDS_OF_CHUNKS = f"""
transform(chunks, c -> aggregate(c, {_NO_ENDS}, (m, x) -> {_FURTHER.format(ends='m')}))
"""
_ENDS_BEFORE = f"""
aggregate({_ENDS_OF_CHUNKS}, array({_NO_ENDS}), (acc, m) ->
  concat(acc, array(map_zip_with(element_at(acc, -1), m, (k, a, b) -> greatest(a, b)))))
"""
_KEPT = f"""
flatten(zip_with(chunks, {_ENDS_BEFORE}, (c, before) -> CASE WHEN c IS NULL
  THEN cast(array() AS {_DETECTIONS})
  ELSE aggregate(c,
    struct(before AS ends, cast(array() AS {_DETECTIONS}) AS kept),
    (acc, x) -> struct(
      {_FURTHER.format(ends='acc.ends')} AS ends,
      CASE WHEN exists(map_entries(acc.ends), e -> e.key >= x.priority AND e.value >= x.end)
           THEN acc.kept
           ELSE concat(acc.kept, array(struct(x.label, x.priority, x.start, x.end))) END AS kept),
    acc -> acc.kept) END))
"""


def _detected(documents: DataFrame, text: str = "text") -> DataFrame:
    """As ``detections``, and with ``__low``, the text in lower case."""
    gate = F.lit(False)
    for words in _gates():
        found = F.lit(True)
        for part in dict.fromkeys(x for word in words for x in (_rare_end(word), word)):
            found = found & F.col("__low").contains(part)
        gate = gate | found
    tried = f"""
      flatten(transform(
        filter({_rule_table()}, g -> forall(g.keywords, k -> contains(__low, k)) AND (g.stem = '' OR __text RLIKE g.stem)),
        g -> g.rules))
    """
    hits = f"""
      flatten(transform({tried}, r -> transform(
        {_spans('r.pattern')},
        s -> struct(s.start AS start, s.end AS end, r.priority AS priority, r.rule AS rule, r.label AS label))))
    """
    # Longest first from each start: what can contain a detection stands before it.
    ordered = f"""
      array_sort({hits}, (a, b) -> CASE
        WHEN a.start <> b.start THEN a.start - b.start
        WHEN a.end <> b.end THEN b.end - a.end
        WHEN a.priority <> b.priority THEN b.priority - a.priority
        ELSE a.rule - b.rule END)
    """
    kept = _named(_chunks("__hits"), "chunks", _KEPT)
    found = documents.withColumn("__text", F.coalesce(F.col(text), F.lit("")))
    # Only the keywords are looked for in lower case; beyond ASCII it may fold more.
    # The one-row generator keeps Catalyst from repeating it for every keyword.
    found = found.withColumn("__low", F.explode(F.array(F.lower("__text"))))
    found = found.withColumn("__hits", F.when(gate, F.expr(ordered)))
    found = found.withColumn("detections", F.coalesce(F.expr(kept), F.expr(f"cast(array() AS {_DETECTIONS})")))
    return found.drop("__text", "__hits")


def detections(documents: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` with ``detections``: label, priority, start and end of what is not suppressed.

    The rules are one constant array; texts without any keyword end at a cheap test.
    """
    return _detected(documents, text).drop("__low")


# So many words at once; each starts behind the last, however long what stands between is.
_COUNTED = 64


def _word_count(text: str) -> Column:
    """The number of words: whole blocks of ``_COUNTED``, and those of the last block."""
    block = f"(?:{_WORD}{_GAP[:-1]}*){{1,{_COUNTED}}}"
    last = f"regexp_extract_all(coalesce(get(blocks, size(blocks) - 1), ''), {_quoted(_WORD)}, 0)"
    count = f"{_COUNTED} * greatest(size(blocks) - 1, 0) + size({last})"
    return F.expr(_named(f"regexp_extract_all({text}, {_quoted(block)}, 0)", "blocks", count))


def _possible(low: str) -> Column:
    """Whether a base phrase can occur in a text of this lower case; never false where one does."""
    low = F.col(low)
    return low.contains("license") | low.contains("cc") & low.contains("by")


def _places(words: str) -> str:
    """(word index, label) of every place of a base phrase."""
    tests = []
    for phrase, label in BASE_PHRASES.values():
        same = " AND ".join(f"get({words}, i + {k}) = '{w}'" for k, w in enumerate(phrase.split()))
        tests.append(f"WHEN {same} THEN '{label}'")
    return f"""
      filter(transform(sequence(0, size({words}) - 1),
                       i -> struct(cast(i AS bigint) AS at, CASE {' '.join(tests)} END AS label)),
             x -> x.label IS NOT NULL)
    """


def scan(documents: DataFrame) -> DataFrame:
    """Per document: words, base places and all labels; see the module's docstring.

    ``score`` is 1 - prod(1 - priority / 100) over the detections and base places
    (priority 50), so more and surer signs give a higher score; 0 without any.
    """
    low = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = _detected(low)
    # An empty string in front of the first or behind the last gap is no word.
    bare = F.regexp_replace("text", rf"^{_GAP}|{_GAP}\z", "")
    words = F.split(ascii_lower(bare), _GAP)
    found = found.withColumn("n_words", _word_count("text").cast("long"))
    found = found.withColumn("__words", F.when(_possible("__low"), words))
    found = found.withColumn("__base", F.coalesce(F.expr(_places("__words")), F.expr("filter(array(struct(0L AS at, '' AS label)), x -> false)")))
    labels = "array_sort(array_distinct(transform({0}, x -> x.label)))"
    own = "transform(detections, x -> x.label)"
    doubt = """aggregate(detections, cast(1 AS double), (p, x) -> p * (1 - x.priority / 100d))
               * power(0.5d, size(__base))"""
    return found.select(
        "doc_id",
        "n_words",
        F.size("__base").cast("long").alias("n_base"),
        F.expr("array_min(transform(__base, x -> x.at))").alias("first_word"),
        F.expr("array_max(transform(__base, x -> x.at))").alias("last_word"),
        F.expr(f"array_join({labels.format('__base')}, ',')").alias("base_labels"),
        F.expr(
            f"array_join(array_sort(array_union(transform(__base, x -> x.label), {own})), ',')"
        ).alias("labels"),
        F.expr(f"1 - {doubt}").alias("score"),
        "detections",
    )
