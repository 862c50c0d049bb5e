"""License scans by ordered signature rules.

Hand-written expressions stand for titles, notices, grants, clauses and web addresses of license texts; for each license
of a table, up to six rules more are made of its name and identifier. One keyword search over a text tells which rules can match at all:
each has its own rare word. What lies between words (white space, line ends, comment marks) counts as one space, and an
offset map leads matches back to the text. SPDX expressions, also as the values of license fields, yield each of their terms. A detection that lies inside the
interval of one with a higher priority, or of a longer one with the same, is dropped.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass
from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import map_columns

#: Phrases, of which the words must stand next to each other, and their labels.
BASE = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

#: Licenses: label, SPDX stem, versions, words of which a text with the name holds one, and an expression for the name.
LICENSES = (
    ("mit", "MIT", "", "mit expat", r"(?:mit|expat)"),
    ("mit-0", "MIT-0", "", "attribution", r"mit[ -]no[ -]attribution"),
    ("apache", "Apache", "1.0 1.1 2.0", "apache", r"apache(?: software)?"),
    ("gpl", "GPL", "1.0 2.0 3.0", "gpl general", r"(?:gnu )?(?:general public|gpl)"),
    ("lgpl", "LGPL", "2.0 2.1 3.0", "lgpl lesser library", r"(?:gnu )?(?:lesser general public|library general public|lgpl)"),
    ("agpl", "AGPL", "1.0 3.0", "agpl affero", r"(?:gnu )?(?:affero general public|agpl)"),
    ("gfdl", "GFDL", "1.1 1.2 1.3", "gfdl documentation", r"(?:gnu )?(?:free documentation|gfdl)"),
    ("bsd", "BSD", "0 1 2 3 4", "bsd", r"(?:new |modified |simplified |original )?(?:[0-4][ -]clause )?bsd"),
    ("mpl", "MPL", "1.0 1.1 2.0", "mozilla", r"mozilla public"),
    ("epl", "EPL", "1.0 2.0", "eclipse", r"eclipse public"),
    ("cddl", "CDDL", "1.0 1.1", "common", r"common development and distribution"),
    ("cpl", "CPL", "1.0", "common", r"common public"),
    ("eupl", "EUPL", "1.0 1.1 1.2", "european", r"european union public"),
    ("isc", "ISC", "", "isc consortium", r"(?:isc|internet systems consortium)"),
    ("zlib", "Zlib", "", "zlib", r"zlib(?:[/ -]libpng)?"),
    ("libpng", "Libpng", "2.0", "png", r"(?:png reference library|libpng)"),
    ("boost", "BSL", "1.0", "boost", r"boost(?: software)?"),
    ("busl", "BUSL", "1.1", "business", r"business source"),
    ("unlicense", "Unlicense", "", "unlicense", r"the unlicense"),
    ("wtfpl", "WTFPL", "", "wtfpl fuck", r"(?:do what the fuck you want to public|wtfpl)"),
    ("artistic", "Artistic", "1.0 2.0", "artistic", r"artistic"),
    ("psf", "PSF", "2.0", "python", r"python software foundation"),
    ("python", "Python", "2.0", "python", r"(?:cnri )?python"),
    ("php", "PHP", "3.0 3.01", "php", r"php"),
    ("ruby", "Ruby", "", "ruby", r"ruby"),
    ("ofl", "OFL", "1.0 1.1", "font", r"(?:sil )?open font"),
    ("afl", "AFL", "1.1 1.2 2.0 2.1 3.0", "academic", r"academic free"),
    ("osl", "OSL", "1.0 2.0 2.1 3.0", "open", r"open software"),
    ("ms-pl", "MS-PL", "", "microsoft", r"microsoft public"),
    ("ms-rl", "MS-RL", "", "microsoft", r"microsoft reciprocal"),
    ("apsl", "APSL", "1.0 1.1 1.2 2.0", "apple", r"apple public source"),
    ("ecl", "ECL", "1.0 2.0", "educational", r"educational community"),
    ("ncsa", "NCSA", "", "ncsa", r"(?:university of illinois[/ -]ncsa|ncsa) open source"),
    ("postgresql", "PostgreSQL", "", "postgresql", r"postgresql"),
    ("openssl", "OpenSSL", "", "openssl", r"openssl(?: ssleay)?"),
    ("vim", "Vim", "", "vim", r"vim"),
    ("x11", "X11", "", "x11", r"x11"),
    ("curl", "curl", "", "curl", r"curl"),
    ("ntp", "NTP", "", "ntp", r"ntp"),
    ("upl", "UPL", "1.0", "universal", r"universal permissive"),
    ("sspl", "SSPL", "1.0", "server", r"server side public"),
    ("elastic", "Elastic", "2.0", "elastic", r"elastic"),
    ("cecill", "CECILL", "1.0 1.1 2.0 2.1", "cecill", r"cecill"),
    ("odbl", "ODbL", "1.0", "database", r"open (?:data commons open )?database"),
    ("cc0", "CC0", "1.0", "cc0 commons", r"(?:creative commons zero|cc0)"),
    ("cc-by", "CC-BY", "1.0 2.0 2.5 3.0 4.0", "commons", r"creative commons attribution"),
    ("cc-by-sa", "CC-BY-SA", "1.0 2.0 2.5 3.0 4.0", "commons", r"creative commons attribution[ -]share[ -]?alike"),
    ("cc-by-nd", "CC-BY-ND", "1.0 2.0 2.5 3.0 4.0", "commons", r"creative commons attribution[ -]no[ -]?deriv(?:ative)?s?"),
    ("cc-by-nc", "CC-BY-NC", "1.0 2.0 2.5 3.0 4.0", "commons", r"creative commons attribution[ -]non[ -]?commercial"),
    ("cc-by-nc-sa", "CC-BY-NC-SA", "1.0 2.0 2.5 3.0 4.0", "commons", r"creative commons attribution[ -]non[ -]?commercial[ -]share[ -]?alike"),
    ("cc-by-nc-nd", "CC-BY-NC-ND", "1.0 2.0 2.5 3.0 4.0", "commons", r"creative commons attribution[ -]non[ -]?commercial[ -]no[ -]?deriv(?:ative)?s?"),
)
#: Hand-written rules for license texts: label, a rare word that every match holds, and an expression over text in small
#: letters with single spaces.
TEXTS = (
    # MIT and its kin
    ("mit", "obtaining", r"permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("mit", "substantial", r"the above copyright notice and this permission notice(?: \(including the next paragraph\))? shall be included in all copies or substantial portions of the software"),
    ("mit", "merchantability", r"the software is provided .{0,2}as is.{0,2}, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability"),
    ("mit", "tort", r"in no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort"),
    ("mit", "opensource.org/licenses/mit", r"https?://(?:www\.)?opensource\.org/licenses/mit(?:-license)?(?:\.php|\.html)?(?![\w-])"),
    ("mit", "mit-licensed", r"(?<!\w)mit-licensed(?!\w)"),
    ("mit-0", "mit-0", r"(?<![\w-])mit-0(?![\w-])"),
    ("x11", "consortium", r"except as contained in this notice, the name of the x consortium shall not be used in advertising"),
    ("x11", "advertising", r"the name of the copyright holders? shall not be used in advertising or otherwise to promote the sale"),
    ("isc", "distribute", r"permission to use, copy, modify, and(?:/or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", "whatsoever", r"in no event shall (?:the author|isc) be liable for any special, direct, indirect, or consequential damages or any damages whatsoever"),
    ("0bsd", "distribute", r"permission to use, copy, modify, and(?:/or)? distribute this software for any purpose with or without fee is hereby granted\. the software is provided"),
    ("curl", "docs/copyright", r"https?://curl\.(?:se|haxx\.se)/docs/copyright\.html"),
    ("ntp", "udel.edu", r"https?://www\.eecis\.udel\.edu/~mills/ntp"),
    ("postgresql", "agreement", r"permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted"),
    ("boost", "organization", r"permission is hereby granted, free of charge, to any person or organization obtaining a copy"),
    ("boost", "boost.org", r"https?://www\.boost\.org/license_1_0\.txt"),
    ("boost", "boost", r"distributed under the boost software license, version 1\.0"),
    ("zlib", "as-is", r"this software is provided .{0,2}as-is.{0,2}, without any express or implied warranty"),
    ("zlib", "misrepresented", r"the origin of this software must not be misrepresented"),
    ("zlib", "altered", r"altered source versions must be plainly marked as such"),
    ("libpng", "png", r"the png reference library is supplied .{0,2}as is.{0,2}"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("unlicense", "unlicense.org", r"https?://unlicense\.org"),
    ("wtfpl", "wtfpl", r"https?://(?:www\.|sam\.zoy\.org/)?wtfpl(?:\.net)?"),
    ("wtfpl", "fuck", r"you just do what the fuck you want to"),
    ("beerware", "beer", r"(?:beer-?ware licen[cs]e|you can buy me a beer in return)"),
    ("json", "evil", r"the software shall be used for good, not evil"),
    ("upl", "universal", r"the universal permissive license \(upl\)"),
    ("afl", "academic", r"licensed under the academic free license version [123]\.[012]"),
    # BSD
    ("bsd", "redistribution", r"redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("bsd", "retain", r"redistributions of source code must retain the (?:above )?copyright notice, this list of conditions"),
    ("bsd", "reproduce", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd", "endorse", r"neither the names? of .{1,80}? nor the names of its contributors may be used to endorse or promote products"),
    ("bsd", "advertising", r"all advertising materials mentioning features or use of this software must display the following acknowledg(?:e)?ment"),
    ("bsd", "provided", r"this software is provided by the (?:copyright holders?|regents|author)(?: and contributors)? .{0,2}as is.{0,2}"),
    ("bsd", "opensource.org/licenses/bsd", r"https?://(?:www\.)?opensource\.org/licenses/bsd-(?:license|[23]-clause)(?:\.php|\.html)?"),
    ("bsd", "bsd", r"(?<![\w-])bsd[ -][0-4][ -]clause(?:[ -](?:clear|patent|modification|licen[cs]e))?(?![\w-])"),
    ("bsd", "clause", r"(?<![\w-])(?:zero|two|three|four|[0-4])[ -]clause (?:modified |simplified |new )?(?:bsd|berkeley)(?: licen[cs]e)?(?!\w)"),
    ("bsd", "berkeley", r"(?<!\w)berkeley software distribution licen[cs]e(?!\w)"),
    ("bsd", "bsd-style", r"(?:governed|licensed) (?:by|under) a bsd-style licen[cs]e"),
    ("ncsa", "illinois", r"university of illinois[/ ]ncsa open source license"),
    ("openssl", "openssl", r"this product includes software developed by the openssl project"),
    ("openssl", "eric", r"this product includes cryptographic software written by eric young"),
    # Apache
    ("apache", "apache", r"licensed under the apache license, version 2\.0 \(the .{0,2}license.{0,2}\)"),
    ("apache", "compliance", r"you may not use this file except in compliance with the license"),
    ("apache", "apache.org/licenses", r"https?://www\.apache\.org/licenses/(?:license-[12]\.[01])?"),
    ("apache", "governing", r"see the license for the specific language governing permissions and limitations under the license"),
    ("apache", "january", r"apache license,? version 2\.0, january 2004"),
    ("apache", "foundation", r"licensed to the apache software foundation \(asf\) under one or more contributor license agreements"),
    ("apache", "apache", r"this product includes software developed (?:by|at) the apache (?:software foundation|group)"),
    ("apache", "perpetual", r"each contributor hereby grants to you a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license"),
    # GNU
    ("gpl", "redistribute", r"this (?:program|library|software|file) is free software[:;,] you can redistribute it and/or modify it under the terms of the gnu general public license"),
    ("gpl", "general", r"gnu general public license,? (?:as published by the free software foundation|version [123])"),
    ("gpl", "fitness", r"without any warranty; without even the implied warranty of merchantability or fitness for a particular purpose\. see the gnu general public license"),
    ("gpl", "gpl", r"(?<!\w)(?:gnu )?gpl ?v?[123](?:\.0)?(?:\+| or later)?(?!\w)"),
    ("gpl", "gnu.org/", r"https?://www\.gnu\.org/(?:licenses|copyleft)/gpl(?:-[123]\.0)?(?:\.(?:html|txt))?"),
    ("gpl", "copyleft", r"the gnu general public license is a free, copyleft license for software and other kinds of works"),
    ("gpl", "general", r"gnu general public license version [123], (?:june 1991|29 june 2007|february 1989)"),
    ("gpl", "gpl", r"(?<![\w-])(?:gnu )?gpl,? (?:version|ver\.?|v\.) ?[123](?:\.0)?(?:\+|,? or (?:\(at your option\) )?(?:any )?later(?: version)?)?(?![\w-]|\.\d)"),
    ("lgpl", "lgpl", r"(?<![\w-])(?:gnu )?lgpl,? (?:version|ver\.?|v\.) ?(?:2\.[01]|[23])(?:\.0)?(?:\+|,? or (?:any )?later(?: version)?)?(?![\w-]|\.\d)"),
    ("agpl", "agpl", r"(?<![\w-])(?:gnu )?agpl,? (?:version|ver\.?|v\.) ?[13](?:\.0)?(?:\+|,? or (?:any )?later(?: version)?)?(?![\w-]|\.\d)"),
    ("lgpl", "gnu", r"under the terms of the gnu (?:lesser|library) general public license"),
    ("lgpl", "lesser", r"this (?:program|library|software) is distributed in the hope that it will be useful.{0,220}? see the gnu lesser general public license"),
    ("lgpl", "lgpl", r"(?<!\w)(?:gnu )?lgpl ?v?(?:2\.1|2|3)(?:\.0)?(?:\+| or later)?(?!\w)"),
    ("lgpl", "gnu.org/", r"https?://www\.gnu\.org/(?:licenses|copyleft)/lgpl(?:-[23]\.[01])?(?:\.(?:html|txt))?"),
    ("agpl", "affero", r"under the terms of the gnu affero general public license"),
    ("agpl", "agpl", r"(?<!\w)(?:gnu )?agpl ?v?[13](?:\.0)?(?:\+| or later)?(?!\w)"),
    ("agpl", "gnu.org/", r"https?://www\.gnu\.org/licenses/agpl(?:-3\.0)?(?:\.(?:html|txt))?"),
    ("gfdl", "invariant", r"with no invariant sections, (?:with )?no front-cover texts,? and (?:with )?no back-cover texts"),
    ("gfdl", "gnu.org/", r"https?://www\.gnu\.org/(?:licenses|copyleft)/fdl(?:-1\.[123])?(?:\.(?:html|txt))?"),
    ("gpl-exception", "exception", r"as a special exception,?(?: .{0,120}?)? gives? you (?:unlimited )?permission to (?:link|copy)"),
    ("classpath-exception", "classpath", r"(?:gnu )?classpath[ -]exception"),
    # file-level and other reciprocal licenses
    ("mpl", "mozilla", r"this source code form is subject to the terms of the mozilla public license,? v\. ?2\.0"),
    ("mpl", "mozilla.org/mpl", r"https?://(?:www\.)?mozilla\.org/mpl/?(?:[12]\.[01]/?)?"),
    ("mpl", "mozilla", r"the contents of this file are subject to the mozilla public license version 1\.[01]"),
    ("mpl", "incompatible", r"this source code form is .{0,2}incompatible with secondary licenses"),
    ("epl", "eclipse", r"this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("epl", "eclipse.org", r"https?://www\.eclipse\.org/(?:legal/epl-v[12]0|org/documents/epl-(?:v10|2\.0))(?:\.html)?"),
    ("cddl", "distribution", r"the contents of this file are subject to the terms of the common development and distribution license(?: \(the .{0,2}license.{0,2}\))?"),
    ("cddl", "cddl", r"cddl header start"),
    ("cpl", "common", r"(?:made available under|licensed under) the (?:terms of the )?common public license v ?1\.0"),
    ("eupl", "eupl", r"licen[cs]ed under the eupl"),
    ("eupl", "joinup", r"https?://joinup\.ec\.europa\.eu/(?:software/page|collection/eupl)/eupl"),
    ("osl", "open", r"licensed under the open software license version [123]\.[01]"),
    ("apsl", "apple", r"this file contains original code and/or modifications of original code as defined in and that are subject to the apple public source license"),
    ("ms-pl", "ms-pl", r"(?<![\w-])ms-pl(?![\w-])"),
    ("ms-rl", "ms-rl", r"(?<![\w-])ms-rl(?![\w-])"),
    ("cecill", "cecill", r"this software is governed by the cecill(?:-[bc])? license under french law"),
    ("cecill", "cecill.info", r"https?://www\.cecill\.info"),
    ("sspl", "mongodb", r"server side public license,? version 1,? as published by mongodb"),
    ("elastic", "elastic", r"licensed under the elastic license(?: 2\.0)?|you may not use this file except in compliance with the elastic license"),
    ("busl", "licensor", r"the licensor hereby grants you the right to copy, modify, create derivative works, redistribute, and make non-production use"),
    ("busl", "change", r"(?:change date:|on the change date)[^.]{0,160}? change license"),
    ("commons-clause", "clause", r"commons clause.{0,3} license condition"),
    ("artistic", "artistic", r"(?:the terms of|under) (?:either )?(?:the perl )?artistic license(?: 2\.0)?"),
    ("artistic", "perl", r"same terms as perl(?: itself|5)?"),
    ("python", "python", r"python software foundation license version 2|psf license agreement for python"),
    ("php", "php", r"this product includes php software, freely available from"),
    ("php", "php.net/license", r"https?://www\.php\.net/license/3_0[01]?\.txt"),
    ("ruby", "ruby", r"(?:under|same) (?:the )?terms (?:as|of) (?:the )?ruby(?:'s)?(?: licen[cs]e)?(?!\w)"),
    ("vim", "vim", r"vim is charityware|the vim license applies"),
    ("qpl", "public", r"the q public license version 1\.0"),
    ("qpl", "qpl", r"licensed under the qpl(?!\w)"),
    ("ipl", "ibm", r"ibm public license version 1\.0"),
    ("npl", "netscape", r"the contents of this file are subject to the netscape public license"),
    ("sleepycat", "sleepycat", r"the sleepycat license"),
    ("sleepycat", "accompanied", r"redistributions in any form must be accompanied by information on how to obtain complete source"),
    ("tcl", "disclaimed", r"terms and conditions apply to all files associated with the software unless explicitly disclaimed"),
    ("ofl", "font", r"this font software is licensed under the sil open font license"),
    ("ofl", "scripts.sil.org", r"https?://scripts\.sil\.org/ofl"),
    ("ofl", "reserved", r"reserved font names? .{1,60}? (?:licensed under|this font)"),
    ("unicode", "unicode", r"unicode,? inc\.? license agreement|unicode license v3|copyright .{0,24}unicode, inc"),
    ("icu", "icu", r"icu license - icu 1\.8\.1 and later"),
    ("w3c", "w3c", r"w3c.{0,3} software (?:and document )?(?:notice and )?license"),
    ("hpnd", "supporting", r"both that copyright notice and this permission notice appear in supporting documentation"),
    ("bouncy-castle", "bouncy", r"the legion of the bouncy castle"),
    ("imagemagick", "imagemagick", r"imagemagick studio llc|licensed under the imagemagick license"),
    ("freetype", "freetype", r"the freetype project license|portions of this software are copyright .{0,30}the freetype project"),
    ("ijg", "jpeg", r"this software is based in part on the work of the independent jpeg group"),
    ("llvm-exception", "llvm", r"apache-2\.0 with llvm-exception|llvm exceptions to the apache 2\.0 license"),
    ("nvidia", "nvidia", r"nvidia corporation and its licensors retain all intellectual property"),
    ("intel", "intel", r"intel simplified software license"),
    ("bigscience-rail", "rail", r"(?:bigscience|creativeml) (?:rail|open ?rail(?:-m)?) licen[cs]e|openrail-m"),
    ("llama", "llama", r"llama (?:2|3|3\.1|3\.2) community license agreement"),
    # Creative Commons and data
    ("cc0", "cc0", r"(?<!\w)cc0 1\.0(?: universal)?(?!\w)"),
    ("cc0", "waived", r"has waived all copyright and related or neighboring rights"),
    ("cc0", "publicdomain/zero", r"https?://creativecommons\.org/publicdomain/zero/1\.0"),
    ("cc-by", "creativecommons.org/licenses/by/", r"https?://creativecommons\.org/licenses/by/[1234]\.[05]"),
    ("cc-by-sa", "creativecommons.org/licenses/by-sa", r"https?://creativecommons\.org/licenses/by-sa/[1234]\.[05]"),
    ("cc-by-nd", "creativecommons.org/licenses/by-nd", r"https?://creativecommons\.org/licenses/by-nd/[1234]\.[05]"),
    ("cc-by-nc", "creativecommons.org/licenses/by-nc/", r"https?://creativecommons\.org/licenses/by-nc/[1234]\.[05]"),
    ("cc-by-nc-sa", "creativecommons.org/licenses/by-nc-sa", r"https?://creativecommons\.org/licenses/by-nc-sa/[1234]\.[05]"),
    ("cc-by-nc-nd", "creativecommons.org/licenses/by-nc-nd", r"https?://creativecommons\.org/licenses/by-nc-nd/[1234]\.[05]"),
    ("cc-by", "by", r"(?<![\w-])cc[- ]by[- ][1234]\.[05](?![\w.-])"),
    ("cc-by-sa", "by", r"(?<![\w-])cc[- ]by[- ]sa(?:[- ][1234]\.[05])?(?![\w-])"),
    ("cc-by-nc", "by", r"(?<![\w-])cc[- ]by[- ]nc(?:[- ][1234]\.[05])?(?![\w-])"),
    ("cc-by-nc-sa", "by", r"(?<![\w-])cc[- ]by[- ]nc[- ]sa(?:[- ][1234]\.[05])?(?![\w-])"),
    ("cc-by-nd", "by", r"(?<![\w-])cc[- ]by[- ]nd(?:[- ][1234]\.[05])?(?![\w-])"),
    ("odbl", "opendatacommons", r"https?://(?:www\.)?opendatacommons\.org/licenses/odbl"),
    ("pddl", "opendatacommons", r"https?://(?:www\.)?opendatacommons\.org/licenses/pddl"),
    ("ogl", "government", r"contains public sector information licensed under the open government licen[cs]e v[123]\.0"),
    ("cdla", "community", r"community data license agreement ?(?:-|–) ?(?:permissive|sharing)"),
    # no license, or rights kept
    ("public-domain", "domain", r"(?:dedicated|released|placed|is) (?:in)?to? ?(?:in )?the public domain(?! license)"),
    ("public-domain", "domain", r"this work is in the public domain"),
    ("public-domain", "claimed", r"no copyright is claimed"),
    ("proprietary", "reserved", r"all rights reserved\.? (?:unauthori[sz]ed|no part)"),
    ("proprietary", "proprietary", r"(?:confidential and proprietary|proprietary and confidential)"),
    ("proprietary", "strictly", r"unauthori[sz]ed (?:copying|reproduction|distribution|use) of this (?:file|software|material|document)[^.]{0,60}? is strictly prohibited"),
    ("proprietary", "agreement", r"subject to (?:the terms of )?a (?:nondisclosure|confidentiality) agreement"),
    ("non-commercial", "non-commercial", r"for (?:personal(?: and|, ?| or) ?)?(?:educational(?:,| and| or) ?)?(?:research )?non-commercial (?:use|purposes) only"),
    ("evaluation", "evaluation", r"licensed for evaluation (?:purposes )?only"),
)
#: Stems whose identifiers name releases of software too: outside of license lines they aren't identifiers.
SOFTWARE = {"Python", "PHP", "Libpng", "Elastic", "PSF"}
#: Confidence of each kind of rule, which is also its priority.
TAG, TEXT, VERSION, TERMS, NAME = 1.0, 0.95, 0.9, 0.8, 0.6
PRIORITIES = (TAG, TEXT, VERSION, TERMS, NAME)


@dataclass(frozen=True)
class Rule:
    """A match needs one of `keywords` in the text, and `also`."""

    label: str
    priority: float
    keywords: tuple[str, ...]
    pattern: re.Pattern
    also: str = ""


@cache
def rules() -> tuple[Rule, ...]:
    """All rules, those of higher priority first; SPDX terms are a table, see `spdx_terms`."""
    out = [Rule(label, TEXT, (keyword,), re.compile(pattern)) for label, keyword, pattern in TEXTS]
    for label, stem, versions, keywords, name in LICENSES:
        words = tuple(keywords.split())
        if versions:
            digits = "|".join(re.escape(v.removesuffix(".0")) + (r"(?:\.0)?" if v.endswith(".0") else "") for v in sorted(versions.split(), key=len, reverse=True))
            out.append(Rule(label, VERSION, words, re.compile(rf"(?<!\w){name} licen[cs]e,? (?:\(\w{{2,8}}\),? )?(?:version |v\.? ?)?(?:{digits})(?!\.?\d)"), "licen"))
            out.append(Rule(label, VERSION, words, re.compile(rf"(?<![\w-]){name}[ -](?:version |v\.? ?)?(?:{digits})[ -]licen[cs]ed?(?!\w)"), "licen"))
            if stem not in SOFTWARE and stem != "BSD":
                whole = "|".join(re.escape(v) for v in sorted(versions.lower().split(), key=len, reverse=True))
                out.append(Rule(label, VERSION, (stem.lower(),), re.compile(rf"(?<![\w.-]){re.escape(stem.lower())}-(?:{whole})(?:-only|-or-later|\+)?(?![\w+-]|\.\w)")))
        out.append(Rule(label, TERMS, words, re.compile(rf"(?:licensed|released|distributed|available|provided) under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?{name}(?: licen[cs]e)?(?!\w)"), "under"))
        out.append(Rule(label, TERMS, words, re.compile(rf"(?<![\w-]){name}[ -]licen[cs]ed(?!\w)"), "licen"))
        out.append(Rule(label, NAME, words, re.compile(rf"(?<!\w){name} licen[cs]e(?!\w)"), "licen"))
    return tuple(sorted(out, key=lambda r: -r.priority))


@cache
def spdx_terms() -> dict[str, str]:
    """SPDX identifiers in small letters, without endings such as -only, and their labels."""
    return {f"{stem}-{version}".rstrip("-").lower(): label for label, stem, versions, _, _ in LICENSES for version in versions.split() or [""]}


SPDX = "spdx-license-identifier"
_SPDX_LINE = re.compile(SPDX + r":[ \t]*([^\n\r]*)")
#: A field of package metadata, whose value is an expression too; it ends where other words begin.
_FIELD = re.compile(r"""(?<![\w-])licen[cs]es?["']?[ \t]*(?::|=>?)[ \t]*[\[({"']*([^\n\r,;}\]"']{1,200})""")
_JOINS = {"and", "or", "with", "the", "license", "licence", "gnu", "version"}
_SPDX_WORD = re.compile(r"[a-z0-9][a-z0-9.+-]*")
_SPDX_ENDING = re.compile(r"(?:-only|-or-later|-clause(?:-[a-z]+)?|\+)$")
#: Gaps between words that aren't one space: white space with or without a comment mark.
_MARK = r"(?:\*+/?|//+|#+|;+|--+|%+|>+|\|+)\s*"
_GAP = re.compile(rf"[^\S ]\s*(?:{_MARK})?| (?:\s+(?:{_MARK})?|{_MARK})")


@cache
def _keywords():
    import ahocorasick

    found = ahocorasick.Automaton()
    for word in sorted({k for r in rules() for k in r.keywords} | {"licen", "under", SPDX}):
        found.add_word(word, word)
    found.make_automaton()
    return found


def folded(low: str) -> tuple[str, list[int], list[int]]:
    """The text with one space for each gap between words, the places after gaps in it, and what to add from each on."""
    parts, places, added, end, size = [], [0], [0], 0, 0
    for m in _GAP.finditer(low):
        parts.append(low[end : m.start()])
        size += m.start() - end + 1
        end = m.end()
        places.append(size)
        added.append(end - size)
    parts.append(low[end:])
    return " ".join(parts), places, added


def spdx(low: str) -> set[tuple[int, int, str, float]]:
    """Each license of SPDX expressions; operators, exceptions and unknown identifiers are passed over."""
    out = set()
    for line in _SPDX_LINE.finditer(low):
        for m in _SPDX_WORD.finditer(low, line.start(1), line.end(1)):
            label = spdx_terms().get(m[0]) or spdx_terms().get(_SPDX_ENDING.sub("", m[0]))
            if label:
                out.add((m.start(), m.end(), label, TAG))
    for field in _FIELD.finditer(low):
        for m in _SPDX_WORD.finditer(low, field.start(1), field.end(1)):
            label = spdx_terms().get(m[0]) or spdx_terms().get(_SPDX_ENDING.sub("", m[0]))
            if label:
                out.add((m.start(), m.end(), label, TAG))
            elif m[0] not in _JOINS and "exception" not in m[0]:
                break
    return out


def outermost(found: set[tuple[int, int, str, float]]) -> list[tuple[int, int, str, float]]:
    """Detections by start, without those inside one of higher priority or a longer one of the same; ties go by label.

    One sweep by start, with the greatest end so far for each priority.
    """
    out, ends = [], dict.fromkeys(PRIORITIES, -1)
    for x in sorted(found, key=lambda x: (x[0], -x[1], -x[3], x[2])):
        if all(end < x[1] for priority, end in ends.items() if priority >= x[3]):
            out.append(x)
        ends[x[3]] = max(ends[x[3]], x[1])
    return out


def detections(low: str) -> list[tuple[int, int, str, float]]:
    """(start, end, label, priority) in a text in small letters, by start; contained ones are gone."""
    there = {word for _, word in _keywords().iter(low)}
    if not there:
        return []
    found = spdx(low) if "licen" in there else set()
    able = [r for r in rules() if (not r.also or r.also in there) and not there.isdisjoint(r.keywords)]
    if able:
        text, places, added = folded(low)
        back = lambda at: at + added[bisect_right(places, at) - 1]
        found.update((back(m.start()), back(m.end() - 1) + 1, r.label, r.priority) for r in able for m in r.pattern.finditer(text))
    return outermost(found)


_LOW = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def scan(text: str | None) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score and the detections of a text."""
    data = (text or "").encode()
    word = _WORD_BYTE[np.frombuffer(data, np.uint8)]
    n_words = int(np.count_nonzero(word[1:] & ~word[:-1]) + (len(word) > 0 and word[0]))
    low = data.translate(_LOW).decode()
    places: list[tuple[int, str]] = []
    if "license" in low:
        words = WORD.findall(low)
        for at, own in enumerate(words):
            if own == "license":
                places += [(at - len(p) + 1, label) for p, label in BASE.items() if at + 1 >= len(p) and tuple(words[at - len(p) + 1 : at + 1]) == p]
    found = detections(low)
    base = {label for _, label in places}
    labels = base | {x[2] for x in found}
    starts = [at for at, _ in places]
    score = max([x[3] for x in found] + [NAME] * bool(places), default=0.0)
    return n_words, len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score, found


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, and detections as spans.

    A null or empty text has no words and no labels, and a score of 0. Rows stay as they are, repeated ones too; other
    columns are ignored. Spans count characters of the text in small ASCII letters, which has the text's length.
    """

    def of(ids: list, texts: list) -> tuple:
        rows = [scan(t) for t in texts]
        found = [[{"start": a, "end": b, "label": label, "priority": p} for a, b, label, p in r[-1]] for r in rows]
        return ids, *([r[k] for r in rows] for k in range(7)), found

    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, detections array<struct<start:int,end:int,label:string,priority:double>>"
    return map_columns(docs.select(F.col("doc_id").cast("long"), "text"), of, schema)
