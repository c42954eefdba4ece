"""Licence scans by sentence rules, in DataFrame functions only.

Known licence sentences have identifiers; a sentence may have variable parts, such as a holder's name. A text is cut into sentences, each is normalised (lower case, letters and digits, single blanks) and
mapped to its identifier; ordered rules then name the licence whose identifier sequence occurs in the text's sequence. A rule that matches
takes its identifiers away, so a later, shorter rule can't claim them again. A rule may also name identifiers that must not follow: a sentence that looks like a licence's but is not known gets an identifier too
(``?endorse`` or ``?license``), so that the shorter of two licences is not claimed beside a clause that nobody has understood. What no rule took is reported as ``unmatched``.

A line's end, or an abbreviation's full stop, may be a sentence's end or lie inside it: a known sentence is found on a line of its own and wrapped over lines, with or without
comment or bullet marks before them. Of the known sentences that begin at one place the first of the table counts, which has the longer of similar ones first. None runs across a blank line (or one of marks only).

All of it is one projection: no shuffle, no Python. A cheap test for words without which no licence can be spares ordinary texts the cutting and mapping.

Defined results: a null or empty text has no sentences, hence no identifiers and no licences. Rows, repeated or not, stay one for one.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import fresh

# How references write the names of licences. In patterns a blank is any gap between words, <> a variable part of 1 to 20 words.
_VERSION = "(?: version| v)*"
_LATER = "(?: or(?: at your option)?(?: any)? (?:later|newer)(?: versions?)?| and later(?: versions?)?| or above)"
_GNU = {"GPL": "(?:gnu general public license(?: gnu gpl| gpl)?|(?:gnu )?gpl)", "LGPL": "(?:gnu (?:lesser|library) general public license(?: lgpl)?|(?:gnu )?lgpl)", "AGPL": "(?:gnu affero general public license(?: agpl)?|(?:gnu )?agpl)"}
_GNU_VERSIONS = {"GPL": ("2.0", "3.0"), "LGPL": ("2.1", "2.0", "3.0"), "AGPL": ("3.0",)}  # 2.1 before 2, which may end at a line's end
NAMES = [
    ("MIT", "(?:mit|expat) license"),
    ("ISC", "isc license"),
    ("Apache-2.0", f"apache(?: software)? license{_VERSION} v?2(?: 0)?"),
    ("Apache-1.1", f"apache(?: software)? license{_VERSION} v?1 1"),
    ("BSD-3-Clause", "(?:(?:3 clause|three clause|new|modified|revised) bsd license|bsd 3 clause(?: license)?)"),
    ("BSD-2-Clause", "(?:(?:2 clause|two clause|simplified) bsd license|bsd 2 clause(?: license)?)"),
    ("0BSD", "zero clause bsd(?: license)?"),
    ("MPL-2.0", f"(?:mozilla public license|mpl){_VERSION} v?2 0"),
    ("EPL-2.0", f"(?:eclipse public license|epl){_VERSION} v?2 0"),
    ("EPL-1.0", f"(?:eclipse public license|epl){_VERSION} v?1 0"),
    ("BSL-1.0", f"boost software license{_VERSION} v?1 0"),
    ("Zlib", "zlib(?: libpng)? license"),
    ("Unlicense", "unlicense"),
    ("CC0-1.0", "(?:creative commons )?(?:cc0|zero)(?: v?1 0)?(?: universal)?(?: public domain dedication)?"),
]


def _version(v: str) -> str:
    return v[0] + "(?: 0)?" if v.endswith(".0") else v.replace(".", " ")


for _family, _versions in _GNU_VERSIONS.items():
    for _v in _versions:
        NAMES += [(f"{_family}-{_v}-or-later", f"{_GNU[_family]}(?: version| v)* ?v?{_version(_v)}{_LATER}"), (f"{_family}-{_v}-only", f"{_GNU[_family]}(?: version| v)* ?v?{_version(_v)}(?: only)?")]
for _v in ("2.0", "2.5", "3.0", "4.0"):
    for _nc in ("", "-NC"):
        for _last in ("", "-SA", "-ND"):
            _long = "creative commons attribution" + (" non ?commercial" if _nc else "") + {"": "", "-SA": " share ?alike", "-ND": " no ?deriv(?:ative)?s?"}[_last]
            _short = "(?:creative commons )?cc by" + _nc.lower().replace("-", " ") + _last.lower().replace("-", " ")
            NAMES.append((f"CC-BY{_nc}{_last}-{_v}", f"(?:{_long}(?: cc by{_nc.lower().replace('-', ' ')}{_last.lower().replace('-', ' ')})?|{_short}) {_v.replace('.', ' ')}(?: international| unported)?(?: public)?"))

_THING = "(?:this|the|these) (?:work|works|file|files|software|program|project|library|code|source code|document|documentation|package|content|module) (?:is|are) "
_REFERENCE = (
    f"(?:(?:{_THING})?(?:dual )?(?:licensed|released|distributed|available|made available|published|provided)(?: to you)? under|the asf licenses this file to you under|this source code form is subject to|use of this source code is governed by) "
    "(?:the |a )?(?:terms of (?:the )?)?"
)
_TERMS = "(?:you can|you may) redistribute (?:it|this (?:program|library|software)) and or modify (?:it )?under the terms of "
_FSF = "(?: as published by the free software foundation)?"
_ANY_LATER = " or at your option any later version"

# Sentences that licences and licence notices consist of, in order, with identifiers. Those that begin with Note: or Title: need no rule, those with Ref: name a licence themselves.
SENTENCES = [
    ("MitGrant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction(?: including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so(?: subject to the following conditions)?)?"),
    ("MitNotice", "the above copyright notice and this permission notice(?: including the next paragraph)? shall be included in all copies or substantial portions of the software"),
    ("MitAsIs", "the software is provided as is without warranty of any kind(?: express or implied including but not limited to the warranties of merchantability fitness for a particular purpose(?: title)? and non ?infringement)?"),
    ("MitLiability", "in no event shall (?:the )?(?:authors|author) or copyright (?:holders|holder) be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("IscGrant", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("ZeroGrant", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("IscAsIs", "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"),
    ("IscLiability", "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software"),
    ("BsdGrant", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("BsdSource", "redistributions of source code must retain the (?:above )?copyright notice this list of conditions and the following disclaimer"),
    ("BsdBinary", "redistributions in binary form must reproduce the (?:above )?copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("BsdAdvert", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("BsdProduct", "this product includes software developed by <>"),
    ("BsdEndorse", "neither the names? of <> nor the names of (?:its|their|any|the|<>) contributors may be used to endorse or promote products derived from this software without (?:specific )?prior written permission"),
    ("BsdEndorse", "neither <> nor the names of (?:its|their|any|the|<>) contributors may be used to endorse or promote products derived from this software without (?:specific )?prior written permission"),
    ("BsdEndorse", "the names? of <> may not be used to endorse or promote products derived from this software without (?:specific )?prior written permission"),
    ("BsdAsIs", "this software is provided by <> as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"),
    ("BsdLiability", "in no event shall <> be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services"),
    ("BsdLoss", "loss of use data or profits"),
    ("BsdTheory", "or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"),
    ("ApacheComply", "you may not use this file except in compliance with the license"),
    ("ApacheCopy", "you may obtain a copy of the license at(?: https? www apache org licenses license 2 0(?: txt| html)?)?"),
    ("ApacheUrl", "https? www apache org licenses license 2 0(?: txt| html)?"),
    ("ApacheUnless", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("ApacheSee", "see the license for the specific language governing permissions and limitations under the license"),
    ("MplIf", "if a copy of the mpl was not distributed with this file you can obtain one at(?: https? (?:www )?mozilla org mpl 2 0)?"),
    ("ZlibAsIs", "this software is provided as is without any express or implied warranty"),
    ("ZlibHeld", "in no event will the authors? be held liable for any damages arising from the use of this software"),
    ("ZlibGrant", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions"),
    ("ZlibOrigin", "the origin of this software must not be misrepresented"),
    ("ZlibClaim", "you must not claim that you wrote the original software"),
    ("ZlibUse", "if you use this software in a product an acknowledg(?:e)?ment in the product documentation would be appreciated but is not required"),
    ("ZlibAltered", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("ZlibNotice", "this notice may not be removed or altered from any source distribution"),
    ("BoostGrant", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following"),
    ("BoostSee", "see accompanying file license 1 0 txt or copy at(?: https? www boost org license 1 0 txt)?"),
    ("UnlicenseFree", "this is free and unencumbered software released into the public domain"),
    ("UnlicenseAnyone", "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"),
    ("Cc0Waive", "to the extent possible under law <> (?:has|have) waived all copyright and related (?:and|or) neighbou?ring rights to <>"),
    ("AllRights", "all rights reserved"),
    ("Note:See", "see (?:the )?license(?: file| txt)? for (?:more )?(?:details|information)"),
    ("Note:Hope", "(?:this (?:program|library|software|file)|it) is distributed in the hope that it will be useful(?: but without any warranty)?"),
    ("Note:Hope", "but without any warranty"),
    ("Note:Implied", "without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("Note:Details", "see the gnu (?:lesser |library |affero )?general public license for more details"),
    ("Note:Received", "you should have received a copy of the gnu (?:lesser |library |affero )?general public license along with this (?:program|library|software|file)"),
    ("Note:IfNot", "if not (?:see|write to) <>"),
    *[(f"Later{v}", f"(?:either )?version {_version(v)} of the license{_ANY_LATER}") for v in ("2.1", "2.0", "3.0")],
    *[(f"Only{v}", f"version {_version(v)}(?: only)?(?: of the license)?(?: only)?") for v in ("2.1", "2.0", "3.0")],
    *[(f"Ref:{f}-{v}-or-later", f"{_TERMS}the {_GNU[f]}{_FSF}(?: either)? version {_version(v)} of the license{_ANY_LATER}") for f, vs in _GNU_VERSIONS.items() for v in vs],
    *[(f"Ref:{f}-{v}-only", f"{_TERMS}(?:version {_version(v)} of the {_GNU[f]}|the {_GNU[f]}(?: version {_version(v)}{_FSF}|{_FSF} version {_version(v)}(?: of the license)?(?: only)?)){_FSF}") for f, vs in _GNU_VERSIONS.items() for v in vs],
    *[(f"{f}Grant", f"{_TERMS}the {_GNU[f]}{_FSF}") for f in _GNU_VERSIONS],
    *[(f"Ref:{spdx}", f"{_REFERENCE}{name}(?: license)?(?: the license)?") for spdx, name in NAMES],
    *[(f"Title:{spdx}", f"(?:the )?{name}(?: license)?") for spdx, name in NAMES],
    ("Copyright", "(?:c )?copyright(?: c [^|~]*| (?:19|20)[^|~]*)"),
    ("Spdx", "spdx license identifier [^|~]+"),
    ("?endorse", "[^|~]*(?:endorse|promote products)[^|~]*"),
    ("?license", "[^|~]*(?:license|permission|redistribut|sublicens|warrant|liab(?:le|ility)|copyright notice)[^|~]*"),
]
# Identifiers of the SPDX list that the tag may name, beside those above.
SPDX = [*dict.fromkeys(n for n, _ in NAMES), "BSD-4-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "MIT-0", "Python-2.0", "WTFPL", "Artistic-2.0", "CDDL-1.0", "OFL-1.1", "PostgreSQL", "NCSA", "X11"]
_BSD_END = "BsdAsIs? BsdLiability? BsdLoss? BsdTheory?"
# Rules in order: the licence, its sequence (x?: may be missing), what must not stand among the four identifiers behind it. The last kind, a lone one, counts only where no other licence was found.
RULES = [
    ("MIT", "MitGrant MitNotice MitAsIs? MitLiability?", ""),
    ("ISC", "IscGrant IscAsIs? IscLiability?", ""),
    ("0BSD", "ZeroGrant IscAsIs? IscLiability?", ""),
    ("BSD-4-Clause", f"Copyright? AllRights? BsdGrant BsdSource BsdBinary? BsdAdvert BsdProduct? BsdEndorse? {_BSD_END}", ""),
    ("BSD-3-Clause", f"Copyright? AllRights? BsdGrant BsdSource BsdBinary? BsdEndorse {_BSD_END}", "BsdAdvert"),
    ("BSD-2-Clause", f"Copyright? AllRights? BsdGrant BsdSource BsdBinary? {_BSD_END}", "?endorse BsdEndorse BsdAdvert"),
    ("Zlib", "ZlibAsIs? ZlibHeld? ZlibGrant ZlibOrigin? ZlibClaim? ZlibUse? ZlibAltered? ZlibNotice?", ""),
    ("BSL-1.0", "BoostGrant", ""),
    ("Unlicense", "UnlicenseFree UnlicenseAnyone?", ""),
    ("CC0-1.0", "Cc0Waive", ""),
    *[(f"{f}-{v}-or-later", f"{f}Grant Later{v}", "") for f, vs in _GNU_VERSIONS.items() for v in vs],
    *[(f"{f}-{v}-only", f"{f}Grant Only{v}", "") for f, vs in _GNU_VERSIONS.items() for v in vs],
    ("Apache-2.0", "Ref:Apache-2.0 ApacheComply ApacheCopy? ApacheUrl? ApacheUnless? ApacheSee?", ""),
    ("MPL-2.0", "Ref:MPL-2.0 MplIf?", ""),
    ("BSL-1.0", "Ref:BSL-1.0 BoostSee?", ""),
]
LONE = [("Proprietary", "Copyright AllRights", "MitGrant IscGrant ZeroGrant BsdGrant ZlibGrant BoostGrant GPLGrant LGPLGrant AGPLGrant ?endorse ?license")]
#: A text without any of these can't have a licence that a rule or a reference names.
ANCHORS = r"license|licence|permission|copyright|software|redistribut|reserved|warranty|under[^a-z0-9]+(?:the[^a-z0-9]+|a[^a-z0-9]+)?(?:terms|cc|creative|gnu|l?gpl|agpl|mpl|epl|bsd|mit|isc|apache|zlib|boost|mozilla|eclipse|law)"

#: A sentence ends at one of these marks before white space or the text's end, at a blank line, and may end at a line's end.
ENDS = "[.;:!?]+([ \\t\\n\\r\\f]|$)"
#: "2)" before an item of a list ends a sentence as well.
ITEM = r"(^|\n)[^a-z0-9\n]*[0-9]{1,2}\)"
#: The tag whose colon ends no sentence.
TAG = "spdx-license-identifier:"
#: Behind these a full stop is an abbreviation's, and no more an end than a line's end is.
SHORT = r"\b(inc|ltd|co|corp|llc|ver|vs|no|nos|dr|mr|mrs|ms|jr|sr|st|univ|dept|[a-z])\.[ \t\n\r\f]"


def normalised(sentence: str) -> str:
    """The Python form of the normalisation, for tests and for adding sentences."""
    return " ".join(re.sub(r"[^a-z0-9]+", " ", sentence.lower()).split()).replace("licence", "license")


def _pattern(template: str, gap: str) -> str:
    """A template with ``gap`` between words."""
    return template.replace(" ?", f"(?:{gap})?").replace(" ", gap).replace("<>", f"[a-z0-9]+(?:{gap}[a-z0-9]+){{0,19}}?")


def _sentence_pattern(gap: str, sentences: list[tuple[str, str]]) -> str:
    return "|".join(_pattern(t, gap) for _, t in sentences)


def _is(sentence: str) -> str:
    return f"^(?:{_pattern(sentence, ' ')})$"


def sentence_ids(text: Column, sentences: list[tuple[str, str]] = SENTENCES, anchors: str | None = ANCHORS) -> Column:
    """The identifiers of a text's known sentences, and of unknown ones that look like a licence's, in order."""
    low = F.lower(text)
    clean = F.regexp_replace(F.replace(low, F.lit("licence"), F.lit("license")), TAG, "spdx license identifier ")
    clean = F.regexp_replace(clean, SHORT, "$1\n")
    clean = F.regexp_replace(F.regexp_replace(F.regexp_replace(clean, ENDS, "\n\n"), ITEM, "\n\n"), r"[^a-z0-9\n]+", " ")
    # From here on "|" is a sentence's end and "~" a line's end that may be one.
    clean = F.trim(F.regexp_replace(F.regexp_replace(clean, r" ?\n ?\n[ \n]*", "|"), r" ?\n ?", "~"))
    clean = F.regexp_replace(clean, "[ ~]all[ ~]rights[ ~]reserved", "|all rights reserved")
    begun = F.regexp_extract_all(clean, F.lit(f"(?:^|[|~])({_sentence_pattern('[ ~]', sentences)})(?=[|~]|$)"), 1)

    def identifier(s: Column) -> Column:
        found = F.lit(None).cast("string")
        for name, template in reversed(sentences):
            label = F.concat(F.lit("Spdx:"), F.substr(s, F.lit(len("spdx license identifier ") + 1))) if name == "Spdx" else F.lit(name)
            found = F.when(s.rlike(_is(template)), label).otherwise(found)
        return found

    ids = F.transform(F.transform(begun, lambda s: F.translate(s, "~", " ")), identifier)
    none = F.array().cast("array<string>")
    return F.coalesce(ids, none) if anchors is None else F.when(low.rlike(anchors), ids).otherwise(none)


def _sequence(rule: str) -> str:
    """A rule's sequence as a pattern over identifiers, each between bars of its own."""
    one = lambda x: rf"\|{re.escape(x)}\|"
    return "".join(f"(?:{one(x[:-1])})?" if x.endswith("?") else one(x) for x in rule.split())


def _never(rule: str, forbidden: str) -> str:
    """The sequence with a forbidden identifier close behind; without any, what no text has."""
    return _sequence(rule) + r"(?:\|[^|]+\|){0,3}\|(?:" + "|".join(map(re.escape, forbidden.split())) + r")\|" if forbidden else "\n"


def _tagged(label: str) -> str:
    return normalised(label).replace(" or later", "-or-later")


def matched_rules(ids: Column, rules: list[tuple[str, str, str]] = RULES, lone: list[tuple[str, str, str]] = LONE) -> Column:
    """struct(rest, found): the licences' names, and what identifiers no rule took.

    An identifier "Spdx:x" or "Ref:x" needs no rule: it names the licence itself, unless a rule took it.
    """
    table = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(_sequence(seq)).alias("seq"), F.lit(_never(seq, bad)).alias("never"), F.lit(alone).alias("alone")) for group, alone in ((rules, False), (lone, True)) for name, seq, bad in group])
    known = F.create_map(*[F.lit(x) for name in SPDX for x in (_tagged(name), name)])
    tags = F.flatten(F.transform(F.filter(ids, lambda x: x.startswith("Spdx:")), lambda x: F.split(F.replace(F.substr(x, F.lit(6)), F.lit(" or later"), F.lit("-or-later")), " (?:or|and) ")))
    named = F.transform(tags, lambda x: F.coalesce(F.try_element_at(known, x), x))
    references = F.transform(F.filter(ids, lambda x: x.startswith("Ref:")), lambda x: F.substr(x, F.lit(5)))
    start = F.struct(F.concat(F.lit("|"), F.array_join(ids, "||"), F.lit("|")).alias("rest"), F.concat(named, references).alias("found"))

    def step(state: Column, rule: Column) -> Column:
        taken = F.struct(F.regexp_replace(state["rest"], rule["seq"], F.lit("")).alias("rest"), F.concat(state["found"], F.array(rule["name"])).alias("found"))
        fits = F.rlike(state["rest"], rule["seq"]) & ~F.rlike(state["rest"], rule["never"]) & ~(rule["alone"] & (F.size(state["found"]) > 0))
        return F.when(fits, taken).otherwise(state)

    return F.aggregate(table, start, step)


#: Identifiers that are no clause of their own.
_QUIET = "^(Spdx|Ref|Note|Title):"


def scan(df: DataFrame, text: str = "text", into: tuple[str, str, str] = ("sentence_ids", "licences", "unmatched")) -> DataFrame:
    """df with the sentences' identifiers, the licences' names and the number of identifiers no rule took.

    A column of df whose name clashes with one of ``into`` is an error; give other names then.
    """
    clash = {c.lower() for c in df.columns} & {c.lower() for c in into}
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already; choose others with into=")
    ids, names, left = into
    found = df.withColumn(ids, sentence_ids(F.col(text).cast("string")))
    result = fresh(found.columns, "_state")
    found = found.withColumn(result, F.when(F.size(ids) > 0, matched_rules(F.col(ids))))
    rest = F.filter(F.split(F.col(result)["rest"], r"\|+"), lambda x: (x != "") & ~x.rlike(_QUIET))
    return found.withColumns({names: F.coalesce(F.array_distinct(F.col(result)["found"]), F.array().cast("array<string>")), left: F.coalesce(F.size(rest), F.lit(0)).cast("long")}).drop(result)


def oracle() -> str:
    """The query op4 in DuckDB's SQL, written from the same tables.

    Its patterns can't look ahead, so each mark between sentences or lines stands there twice: the sentence before takes one, the one behind it the other.
    """
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    known = " ".join(f"WHEN regexp_full_match(s, {quote(_pattern(t, ' '))}) THEN " + (f"'Spdx:' || substr(s, {len('spdx license identifier ') + 1})" if k == "Spdx" else quote(k)) for k, t in SENTENCES)
    tags = " ".join(f"WHEN {quote(_tagged(name))} THEN {quote(name)}" for name in SPDX)
    steps = []
    for i, (name, seq, bad, alone) in enumerate([(*r, False) for r in RULES] + [(*r, True) for r in LONE], 1):
        fits = f"regexp_matches(rest, {quote(_sequence(seq))})" + (f" AND NOT regexp_matches(rest, {quote(_never(seq, bad))})" if bad else "") + (" AND len(found) = 0" if alone else "")
        steps.append(f"r{i} AS (SELECT doc_id, ids, CASE WHEN {fits} THEN regexp_replace(rest, {quote(_sequence(seq))}, '', 'g') ELSE rest END AS rest, CASE WHEN {fits} THEN list_append(found, {quote(name)}) ELSE found END AS found FROM r{i - 1})")
    return rf"""
WITH low AS (
  SELECT doc_id, regexp_replace(regexp_replace(replace(lower(coalesce(text, '')), 'licence', 'license'), {quote(TAG)}, 'spdx license identifier ', 'g'), {quote(SHORT)}, '\1' || chr(10), 'g') AS t FROM documents
), cut AS (
  SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(t, {quote(ENDS)}, chr(10) || chr(10), 'g'), {quote(ITEM)}, chr(10) || chr(10), 'g'), '[^a-z0-9\n]+', ' ', 'g') AS t FROM low
), marked AS (
  SELECT doc_id, regexp_replace(trim(regexp_replace(regexp_replace(t, ' ?\n ?\n[ \n]*', '|', 'g'), ' ?\n ?', '~', 'g'), ' '), '[ ~]all[ ~]rights[ ~]reserved', '|all rights reserved', 'g') AS t FROM cut
), said AS (
  SELECT doc_id, list_transform(regexp_extract_all(replace(replace('|' || t || '|', '|', '||'), '~', '~~'), {quote("[|~](" + _sentence_pattern("(?: |~~)", SENTENCES) + ")[|~]")}, 1), lambda s: replace(s, '~~', ' ')) AS said FROM marked
), known AS (
  SELECT doc_id, list_transform(said, lambda s: CASE {known} END) AS ids FROM said
), r0 AS (
  SELECT doc_id, ids, '|' || array_to_string(ids, '||') || '|' AS rest, list_concat(list_transform(flatten(list_transform(list_filter(ids, lambda x: starts_with(x, 'Spdx:')), lambda x: regexp_split_to_array(replace(substr(x, 6), ' or later', '-or-later'), ' (?:or|and) '))),
    lambda x: CASE x {tags} ELSE x END), list_transform(list_filter(ids, lambda x: starts_with(x, 'Ref:')), lambda x: substr(x, 5))) AS found FROM known
), {", ".join(steps)}
SELECT doc_id, array_to_string(ids, ',') AS sentence_ids, array_to_string(list_sort(list_distinct(found)), ',') AS licences,
  CAST(len(list_filter(string_split(rest, '|'), lambda x: x <> '' AND NOT regexp_matches(x, '{_QUIET}'))) AS BIGINT) AS unmatched
FROM r{len(RULES) + len(LONE)}"""
