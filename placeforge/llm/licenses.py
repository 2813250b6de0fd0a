"""Licence scans with DataFrame functions only: ordered signature rules behind a keyword gate, overlaps settled by priority and containment."""

from __future__ import annotations

from functools import reduce
from itertools import count
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeforge.llm.common import bound, running

#: Between words stand ASCII signs; digits, letters and all beyond ASCII make words. Case of A-Z doesn't matter.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Phrases of the base scan and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Licence families. label: name as a pattern over lower-case words, short name as a pattern, keyword that gates both.
# Versions are written as the words they become ("2.0" is "2 0").
FAMILIES = {
    "apache-2.0": (r"apache(?: software)? license,? version 2(?: 0)?|apache license 2(?: 0)?", r"apache 2(?: 0)?", "apache"),
    "apache-1.1": (r"apache software license(?: version)? 1 1", r"apache 1 1", "apache"),
    "mit": (r"(?:the )?mit licen[sc]e", r"mit", "mit"),
    "mit-0": (r"mit no attribution(?: license)?", r"mit 0", "mit"),
    "x11": (r"x11 licen[sc]e|mit x11 licen[sc]e", r"x11", "x11"),
    "bsd-2-clause": (r"(?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd) licen[sc]e", r"bsd 2 clause", "bsd|freebsd"),
    "bsd-3-clause": (r"(?:new bsd|revised bsd|modified bsd|bsd 3 clause|3 clause bsd) licen[sc]e", r"bsd 3 clause", "bsd"),
    "bsd-4-clause": (r"(?:original bsd|bsd 4 clause|4 clause bsd) licen[sc]e", r"bsd 4 clause", "bsd"),
    "0bsd": (r"(?:zero clause|0 clause) bsd(?: licen[sc]e)?|bsd zero clause", r"0bsd", "bsd|0bsd"),
    "isc": (r"isc licen[sc]e", r"isc", "isc"),
    "gpl-3.0": (r"gnu general public licen[sc]e(?: as published by the free software foundation)?(?: either)? (?:version |v)?3(?: 0)?|gnu gpl (?:version |v)?3", r"gpl v?3(?: 0)?(?: only)?", "gnu|gpl"),
    "gpl-2.0": (r"gnu general public licen[sc]e(?: as published by the free software foundation)?(?: either)? (?:version |v)?2(?: 0)?|gnu gpl (?:version |v)?2", r"gpl v?2(?: 0)?(?: only)?", "gnu|gpl"),
    "gpl": (r"gnu general public licen[sc]e", r"gnu gpl", "gnu"),
    "lgpl-3.0": (r"gnu lesser general public licen[sc]e (?:version |v)?3(?: 0)?", r"lgpl v?3(?: 0)?(?: only)?", "gnu|lgpl"),
    "lgpl-2.1": (r"gnu lesser general public licen[sc]e (?:version |v)?2 1", r"lgpl v?2 1(?: only)?", "gnu|lgpl"),
    "lgpl": (r"gnu (?:lesser|library) general public licen[sc]e", r"gnu lgpl", "gnu"),
    "agpl-3.0": (r"gnu affero general public licen[sc]e(?: (?:version |v)?3(?: 0)?)?", r"agpl v?3(?: 0)?(?: only)?", "affero|agpl"),
    "gpl-3.0-or-later": (r"gnu general public licen[sc]e (?:version |v)?3(?: 0)? or (?:any )?later(?: version)?", r"gpl v?3(?: 0)? or later", "gnu|gpl"),
    "gpl-2.0-or-later": (r"gnu general public licen[sc]e (?:version |v)?2(?: 0)? or (?:any )?later(?: version)?", r"gpl v?2(?: 0)? or later", "gnu|gpl"),
    "lgpl-3.0-or-later": (r"gnu lesser general public licen[sc]e (?:version |v)?3(?: 0)? or (?:any )?later(?: version)?", r"lgpl v?3(?: 0)? or later", "gnu|lgpl"),
    "lgpl-2.1-or-later": (r"gnu lesser general public licen[sc]e (?:version |v)?2 1 or (?:any )?later(?: version)?", r"lgpl v?2 1 or later", "gnu|lgpl"),
    "agpl-3.0-or-later": (r"gnu affero general public licen[sc]e (?:version |v)?3(?: 0)? or (?:any )?later(?: version)?", r"agpl v?3(?: 0)? or later", "affero|agpl"),
    "gfdl": (r"gnu free documentation licen[sc]e", r"gfdl(?: 1 [1-3])?", "gnu|gfdl"),
    "mpl-2.0": (r"mozilla public licen[sc]e(?: version| v)? 2(?: 0)?", r"mpl 2(?: 0)?", "mozilla|mpl"),
    "mpl-1.1": (r"mozilla public licen[sc]e(?: version| v)? 1 1", r"mpl 1 1", "mozilla|mpl"),
    "epl-2.0": (r"eclipse public licen[sc]e(?: version| v)? 2(?: 0)?", r"epl 2(?: 0)?", "eclipse|epl"),
    "epl-1.0": (r"eclipse public licen[sc]e(?: version| v)? 1(?: 0)?", r"epl 1(?: 0)?", "eclipse|epl"),
    "cddl-1.0": (r"common development and distribution licen[sc]e", r"cddl(?: 1 [01])?", "cddl|common"),
    "cpl-1.0": (r"common public licen[sc]e", r"cpl 1(?: 0)?", "cpl|common"),
    "eupl": (r"european union public licen[sc]e", r"eupl(?: v)?(?: 1 [0-2])?", "european|eupl"),
    "artistic-2.0": (r"artistic licen[sc]e(?: version)? 2(?: 0)?", r"artistic 2(?: 0)?", "artistic"),
    "artistic-1.0": (r"(?:perl )?artistic licen[sc]e", r"artistic 1(?: 0)?", "artistic"),
    "bsl-1.0": (r"boost software licen[sc]e", r"bsl 1(?: 0)?", "boost|bsl"),
    "zlib": (r"zlib(?: libpng)? licen[sc]e", r"zlib", "zlib"),
    "libpng": (r"libpng licen[sc]e", r"libpng", "libpng"),
    "unlicense": (r"(?:the )?unlicense|released into the public domain", r"unlicense", "unlicense|domain"),
    "wtfpl": (r"do what the f\w* you want to public licen[sc]e", r"wtfpl", "wtfpl|want"),
    "cc0-1.0": (r"creative commons (?:cc0|zero|public domain dedication)", r"cc0(?: 1 0)?", "cc0|creative"),
    "cc-by-4.0": (r"creative commons attribution 4 0(?: international)?(?: licen[sc]e)?", r"cc by 4 0", "creative|cc"),
    "cc-by-3.0": (r"creative commons attribution 3 0(?: unported)?(?: licen[sc]e)?", r"cc by 3 0", "creative|cc"),
    "cc-by-sa-4.0": (r"creative commons attribution share ?alike 4 0(?: international)?(?: licen[sc]e)?", r"cc by sa 4 0", "creative|cc"),
    "cc-by-sa-3.0": (r"creative commons attribution share ?alike 3 0(?: unported)?(?: licen[sc]e)?", r"cc by sa 3 0", "creative|cc"),
    "cc-by-nc-4.0": (r"creative commons attribution non ?commercial 4 0(?: international)?(?: licen[sc]e)?", r"cc by nc 4 0", "creative|cc"),
    "cc-by-nc-sa-4.0": (r"creative commons attribution non ?commercial share ?alike 4 0(?: international)?(?: licen[sc]e)?", r"cc by nc sa 4 0", "creative|cc"),
    "cc-by-nd-4.0": (r"creative commons attribution no ?deriv\w* 4 0(?: international)?(?: licen[sc]e)?", r"cc by nd 4 0", "creative|cc"),
    "cc-by-nc-nd-4.0": (r"creative commons attribution non ?commercial no ?deriv\w* 4 0(?: international)?(?: licen[sc]e)?", r"cc by nc nd 4 0", "creative|cc"),
    "python-2.0": (r"(?:python software foundation|psf) licen[sc]e(?: version 2)?", r"psf 2(?: 0)?|python 2 0", "python|psf"),
    "ruby": (r"ruby licen[sc]e", r"ruby", "ruby"),
    "php-3.01": (r"php licen[sc]e(?: version)? 3 0?1", r"php 3 0?1", "php"),
    "postgresql": (r"postgresql licen[sc]e", r"postgresql", "postgresql"),
    "openssl": (r"openssl licen[sc]e", r"openssl", "openssl"),
    "ofl-1.1": (r"sil open font licen[sc]e", r"ofl 1 1", "sil|ofl"),
    "ncsa": (r"(?:university of illinois )?ncsa open source licen[sc]e", r"ncsa", "ncsa"),
    "ms-pl": (r"microsoft public licen[sc]e", r"ms pl", "microsoft|ms"),
    "ms-rl": (r"microsoft reciprocal licen[sc]e", r"ms rl", "microsoft|ms"),
    "osl-3.0": (r"open software licen[sc]e(?: version)? 3(?: 0)?", r"osl 3(?: 0)?", "open|osl"),
    "afl-3.0": (r"academic free licen[sc]e(?: version)? 3(?: 0)?", r"afl 3(?: 0)?", "academic|afl"),
    "ecl-2.0": (r"educational community licen[sc]e", r"ecl 2(?: 0)?", "educational|ecl"),
    "upl-1.0": (r"universal permissive licen[sc]e", r"upl 1(?: 0)?", "universal|upl"),
    "bsd": (r"bsd(?: style)? licen[sc]e", r"bsd style", "bsd"),
    "apache": (r"apache licen[sc]e", r"apache style", "apache"),
    "cc": (r"creative commons licen[sc]e", r"creative commons", "creative"),
    "sspl-1.0": (r"server side public licen[sc]e", r"sspl 1(?: 0)?", "sspl|server"),
    "busl-1.1": (r"business source licen[sc]e", r"busl 1 1", "business|busl"),
    "elastic-2.0": (r"elastic licen[sc]e", r"elastic 2(?: 0)?", "elastic"),
}

# Forms in which a family is named; {n}: its name, {s}: its short name. The weight is the rule's share of the score.
FORMS = (
    (r"spdx license identifier (?:{s})", 1.0),
    (r"(?:is |are )?(?:dual |re)?licen[sc]ed under (?:the )?(?:terms of )?(?:the )?(?:{n})", 0.95),
    (r"(?:under|by) the terms of (?:the )?(?:{n})", 0.9),
    (r"(?:released|distributed|available|provided|published) under (?:the )?(?:{n}|{s} licen[sc]e)", 0.9),
    (r"licen[sc]ed under (?:the )?(?:{s})", 0.85),
    (r"(?:{n})", 0.7),
)

#: Where an SPDX tag stands in the text, further members of its expression.
EXPRESSION, EXPRESSION_WEIGHT = r"(?:or|and) (?:{s})", 0.9

# Short forms as people write them, by label: pattern, keyword that it holds, weight. A plus sign is no word, so "GPLv3+" is "gplv3".
SHORT = (
    ("gpl-3.0-or-later", r"(?:gnu )?gpl(?: version | v|v| )?3(?: 0)? or (?:any )?later(?: version)?", "gpl|gplv3|gpl3", 0.85),
    ("gpl-2.0-or-later", r"(?:gnu )?gpl(?: version | v|v| )?2(?: 0)? or (?:any )?later(?: version)?", "gpl|gplv2|gpl2", 0.85),
    ("lgpl-3.0-or-later", r"(?:gnu )?lgpl(?: version | v|v| )?3(?: 0)? or (?:any )?later(?: version)?", "lgpl|lgplv3|lgpl3", 0.85),
    ("lgpl-2.1-or-later", r"(?:gnu )?lgpl(?: version | v|v| )?2 1 or (?:any )?later(?: version)?", "lgpl|lgplv2|lgpl2", 0.85),
    ("agpl-3.0-or-later", r"(?:gnu )?agpl(?: version | v|v| )?3(?: 0)? or (?:any )?later(?: version)?", "agpl|agplv3|agpl3", 0.85),
    ("gpl-3.0", r"(?:gnu )?gpl(?: version | v|v| )?3(?: 0)?(?: only)?(?: licen[sc]ed?)?", "gpl|gplv3|gpl3", 0.8),
    ("gpl-2.0", r"(?:gnu )?gpl(?: version | v|v| )?2(?: 0)?(?: only)?(?: licen[sc]ed?)?", "gpl|gplv2|gpl2", 0.8),
    ("lgpl-3.0", r"(?:gnu )?lgpl(?: version | v|v| )?3(?: 0)?(?: only)?(?: licen[sc]ed?)?", "lgpl|lgplv3|lgpl3", 0.8),
    ("lgpl-2.1", r"(?:gnu )?lgpl(?: version | v|v| )?2 1(?: only)?(?: licen[sc]ed?)?", "lgpl|lgplv2|lgpl2", 0.8),
    ("agpl-3.0", r"(?:gnu )?agpl(?: version | v|v| )?3(?: 0)?(?: only)?(?: licen[sc]ed?)?", "agpl|agplv3|agpl3", 0.8),
    ("gpl", r"(?:gnu )?gpl(?: licen[sc]ed?)?", "gpl", 0.6),
    ("lgpl", r"(?:gnu )?lgpl(?: licen[sc]ed?)?", "lgpl", 0.6),
    ("agpl", r"(?:gnu )?agpl(?: licen[sc]ed?)?", "agpl", 0.6),
    ("apache-2.0", r"apache(?: licen[sc]e)?(?: version | v|v| )?2(?: 0)?(?: licen[sc]ed?)?|asl ?v?2(?: 0)?", "apache|apachev2|apache2|asl|aslv2|asl2", 0.8),
    ("mit", r"mit(?: style)? licen[sc]ed", "mit", 0.8),
    ("bsd-3-clause", r"(?:bsd 3 clause|3 clause bsd|bsd3)(?: licen[sc]ed?)?", "bsd|bsd3", 0.8),
    ("bsd-2-clause", r"(?:bsd 2 clause|2 clause bsd|bsd2)(?: licen[sc]ed?)?", "bsd|bsd2", 0.8),
    ("bsd", r"bsd(?: style)? licen[sc]ed", "bsd", 0.7),
    ("0bsd", r"0bsd", "0bsd", 0.8),
    ("isc", r"isc licen[sc]ed", "isc", 0.8),
    ("mpl-2.0", r"mpl ?v?2(?: 0)?", "mpl|mplv2|mpl2", 0.8),
    ("mpl-1.1", r"mpl ?v?1 1", "mpl|mplv1|mpl1", 0.8),
    ("epl-2.0", r"epl ?v?2(?: 0)?", "epl|eplv2|epl2", 0.8),
    ("epl-1.0", r"epl ?v?1(?: 0)?", "epl|eplv1|epl1", 0.8),
    ("eupl", r"eupl ?v?1 [0-2]", "eupl|euplv1|eupl1", 0.8),
    ("cddl-1.0", r"cddl ?v?1 0", "cddl|cddlv1|cddl1", 0.8),
    ("artistic-2.0", r"artistic 2(?: 0)?", "artistic", 0.7),
    ("bsl-1.0", r"bsl 1 0|boost 1 0", "bsl|boost", 0.8),
    ("busl-1.1", r"busl 1 1", "busl", 0.8),
    ("sspl-1.0", r"sspl(?: v?1)?", "sspl", 0.8),
    ("wtfpl", r"wtfpl", "wtfpl", 0.8),
    ("ofl-1.1", r"ofl 1 1", "ofl", 0.8),
    ("ms-pl", r"ms pl", "ms", 0.7),
    ("gfdl", r"gfdl(?: v?1 [1-3])?", "gfdl", 0.8),
    ("cc0-1.0", r"cc ?0(?: 1 0)?(?: universal)?", "cc0|cc", 0.8),
    ("cc-by-4.0", r"cc by v?4 0", "cc", 0.8),
    ("cc-by-3.0", r"cc by v?3 0", "cc", 0.8),
    ("cc-by-sa-4.0", r"cc by sa v?4 0", "cc", 0.8),
    ("cc-by-sa-3.0", r"cc by sa v?3 0", "cc", 0.8),
    ("cc-by-nc-4.0", r"cc by nc v?4 0", "cc", 0.8),
    ("cc-by-nc-sa-4.0", r"cc by nc sa v?4 0", "cc", 0.8),
    ("cc-by-nd-4.0", r"cc by nd v?4 0", "cc", 0.8),
    ("cc-by-nc-nd-4.0", r"cc by nc nd v?4 0", "cc", 0.8),
    ("classpath-exception-2.0", r"(?:with )?classpath exception(?: 2 0)?", "classpath", 0.8),
    ("llvm-exception", r"(?:with )?llvm exception", "llvm", 0.8),
    ("gcc-exception-3.1", r"(?:with )?gcc exception(?: 3 1)?", "gcc", 0.8),
)

# Sentences of licence texts and notices, by label: pattern, keyword that it holds, weight.
SENTENCES = (
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy", "granted", 0.95),
    ("mit", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "portions", 0.9),
    ("mit", r"to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense", "sublicense", 0.9),
    ("x11", r"except as contained in this notice the name(?:s)? of (?:\S+ ){1,12}shall not be used in advertising", "advertising", 0.9),
    ("isc", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted", "granted", 0.95),
    ("isc", r"the software is provided as is and the author disclaims all warranties", "disclaims", 0.8),
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted", "redistribution", 0.95),
    ("bsd", r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", "redistributions", 0.9),
    ("bsd", r"redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer", "redistributions", 0.9),
    ("bsd-3-clause", r"neither the name of (?:\S+ ){1,12}nor the names of its contributors", "contributors", 0.9),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software must display", "advertising", 0.9),
    ("bsd", r"this software is provided by (?:\S+ ){1,12}as is and any express or implied warranties", "warranties", 0.6),
    ("apache-2.0", r"you may not use this file except in compliance with the licen[sc]e", "compliance", 0.85),
    ("apache-2.0", r"unless required by applicable law or agreed to in writing software distributed under the licen[sc]e is distributed on an as is basis", "basis", 0.85),
    ("apache-2.0", r"terms and conditions for use reproduction and distribution", "reproduction", 0.8),
    ("apache-2.0", r"see the licen[sc]e for the specific language governing permissions and limitations", "limitations", 0.8),
    ("apache-2.0", r"each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright licen[sc]e", "irrevocable", 0.9),
    ("apache-1.1", r"the end user documentation included with the redistribution if any must include the following acknowledgment", "acknowledgment", 0.9),
    ("gpl", r"this program is free software you can redistribute it and or modify it", "redistribute", 0.9),
    ("gpl", r"you should have received a copy of the gnu general public licen[sc]e", "received", 0.9),
    ("gpl", r"this program is distributed in the hope that it will be useful but without any warranty", "warranty", 0.85),
    ("gpl", r"everyone is permitted to copy and distribute verbatim copies of this licen[sc]e document but changing it is not allowed", "verbatim", 0.8),
    ("gpl-2.0", r"the licen[sc]es for most software are designed to take away your freedom to share and change it", "freedom", 0.95),
    ("gpl-2.0", r"activities other than copying distribution and modification are not covered by this licen[sc]e", "activities", 0.9),
    ("gpl-3.0", r"the gnu general public licen[sc]e is a free copyleft licen[sc]e for software and other kinds of works", "copyleft", 0.95),
    ("gpl-3.0", r"to propagate a work means to do anything with it that without permission", "propagate", 0.95),
    ("gpl-2.0-or-later", r"either version 2 of the licen[sc]e or at your option any later version", "license|licence", 0.9),
    ("gpl-3.0-or-later", r"either version 3 of the licen[sc]e or at your option any later version", "license|licence", 0.9),
    ("lgpl", r"this library is free software you can redistribute it and or modify it", "redistribute", 0.9),
    ("lgpl", r"you should have received a copy of the gnu (?:lesser|library) general public licen[sc]e", "received", 0.9),
    ("lgpl-2.1", r"a work that uses the library in isolation is not a derivative work of the library", "isolation", 0.9),
    ("lgpl-3.0", r"this version of the gnu lesser general public licen[sc]e incorporates the terms and conditions of version 3", "incorporates", 0.95),
    ("agpl-3.0", r"you should have received a copy of the gnu affero general public licen[sc]e", "affero", 0.95),
    ("agpl-3.0", r"your modified version must prominently offer all users interacting with it remotely through a computer network", "remotely", 0.95),
    ("gfdl", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[sc]e", "documentation", 0.95),
    ("gfdl", r"with no invariant sections no front cover texts and no back cover texts", "invariant", 0.9),
    ("mpl-2.0", r"this source code form is subject to the terms of the mozilla public licen[sc]e", "mozilla", 0.95),
    ("mpl-2.0", r"if a copy of the mpl was not distributed with this file you can obtain one", "mpl", 0.95),
    ("mpl-2.0", r"incompatible with secondary licen[sc]es", "secondary", 0.85),
    ("mpl-1.1", r"the contents of this file are subject to the mozilla public licen[sc]e version 1 1", "mozilla", 0.95),
    ("epl-2.0", r"this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e", "eclipse", 0.95),
    ("epl-1.0", r"the accompanying program is provided under the terms of this eclipse public licen[sc]e agreement", "eclipse", 0.95),
    ("epl-1.0", r"any use reproduction or distribution of the program constitutes recipient(?: ?s)? acceptance of this agreement", "acceptance", 0.85),
    ("cddl-1.0", r"the contents of this file are subject to the terms of the common development and distribution licen[sc]e", "common", 0.95),
    ("cddl-1.0", r"when distributing covered code include this cddl header", "cddl", 0.95),
    ("eupl", r"licen[sc]ed under the eupl version 1 [0-2]", "eupl", 0.95),
    ("artistic-1.0", r"the intent of this document is to state the conditions under which a package may be copied", "copied", 0.9),
    ("artistic-2.0", r"this licen[sc]e establishes the terms under which a given free software package may be copied modified distributed", "establishes", 0.9),
    ("bsl-1.0", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this licen[sc]e", "organization", 0.95),
    ("zlib", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable", "warranty", 0.8),
    ("zlib", r"the origin of this software must not be misrepresented you must not claim that you wrote the original software", "misrepresented", 0.95),
    ("zlib", r"altered source versions must be plainly marked as such", "altered", 0.9),
    ("unlicense", r"this is free and unencumbered software released into the public domain", "unencumbered", 0.95),
    ("unlicense", r"anyone is free to copy modify publish use compile sell or distribute this software", "compile", 0.9),
    ("wtfpl", r"you just do what the f\w* you want to", "want", 0.95),
    ("cc0-1.0", r"the person who associated a work with this deed has dedicated the work to the public domain", "deed", 0.95),
    ("cc0-1.0", r"waiving all of his or her rights to the work worldwide under copyright law", "waiving", 0.9),
    ("cc0-1.0", r"creativecommons org publicdomain zero 1 0", "publicdomain", 0.95),
    ("cc-by-4.0", r"creativecommons org licen[sc]es by 4 0", "creativecommons", 0.95),
    ("cc-by-3.0", r"creativecommons org licen[sc]es by 3 0", "creativecommons", 0.95),
    ("cc-by-sa-4.0", r"creativecommons org licen[sc]es by sa 4 0", "creativecommons", 0.95),
    ("cc-by-sa-3.0", r"creativecommons org licen[sc]es by sa 3 0", "creativecommons", 0.95),
    ("cc-by-nc-4.0", r"creativecommons org licen[sc]es by nc 4 0", "creativecommons", 0.95),
    ("cc-by-nc-sa-4.0", r"creativecommons org licen[sc]es by nc sa 4 0", "creativecommons", 0.95),
    ("cc-by-nd-4.0", r"creativecommons org licen[sc]es by nd 4 0", "creativecommons", 0.95),
    ("cc-by-nc-nd-4.0", r"creativecommons org licen[sc]es by nc nd 4 0", "creativecommons", 0.95),
    ("cc", r"you are free to share copy and redistribute the material in any medium or format", "redistribute", 0.85),
    ("cc", r"you must give appropriate credit provide a link to the licen[sc]e and indicate if changes were made", "credit", 0.85),
    ("cc-by-sa", r"if you remix transform or build upon the material you must distribute your contributions under the same licen[sc]e as the original", "remix", 0.85),
    ("cc-by-nc", r"you may not use the material for commercial purposes", "commercial", 0.8),
    ("cc-by-nd", r"if you remix transform or build upon the material you may not distribute the modified material", "remix", 0.85),
    ("python-2.0", r"this licen[sc]e agreement is between the python software foundation", "python", 0.95),
    ("php-3.01", r"products derived from this software may not be called php", "php", 0.95),
    ("postgresql", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted", "granted", 0.95),
    ("openssl", r"this product includes software developed by the openssl project", "openssl", 0.95),
    ("ofl-1.1", r"the goals of the open font licen[sc]e ofl are to stimulate worldwide development of collaborative font projects", "ofl", 0.95),
    ("ofl-1.1", r"this font software is licen[sc]ed under the sil open font licen[sc]e", "sil", 0.95),
    ("ncsa", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal with the software without restriction", "granted", 0.95),
    ("ms-pl", r"this licen[sc]e governs use of the accompanying software if you use the software you accept this licen[sc]e", "governs", 0.9),
    ("sspl-1.0", r"if you make the functionality of the program or a modified version available to third parties as a service", "functionality", 0.95),
    ("busl-1.1", r"the licensor may make an additional use grant above permitting limited production use", "licensor", 0.95),
    ("elastic-2.0", r"you may not provide the software to third parties as a hosted or managed service", "hosted", 0.95),
    ("commons-clause", r"the grant of rights under the licen[sc]e will not include and the licen[sc]e does not grant to you the right to sell the software", "grant", 0.95),
    ("json", r"the software shall be used for good not evil", "evil", 0.95),
    ("beerware", r"as long as you retain this notice you can do whatever you want with this stuff", "stuff", 0.95),
    ("jpeg", r"this software is based in part on the work of the independent jpeg group", "jpeg", 0.95),
    ("curl", r"permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", "granted", 0.9),
    ("public-domain", r"(?:placed|dedicated|is) (?:in|into|to) the public domain", "domain", 0.7),
    ("public-domain", r"no copyright is claimed", "claimed", 0.6),
    ("public-domain", r"no rights reserved", "reserved", 0.6),
    ("proprietary", r"all rights reserved", "reserved", 0.3),
    ("proprietary", r"proprietary and confidential", "proprietary", 0.5),
    ("proprietary", r"unauthori[sz]ed (?:copying|reproduction|use) of this (?:file|software|document)(?: via any medium)? is strictly prohibited", "prohibited", 0.6),
    ("proprietary", r"this software is licen[sc]ed not sold", "sold", 0.6),
    ("proprietary", r"may not be (?:reproduced|copied|redistributed) (?:\S+ ){0,8}without (?:the )?(?:prior |express )*(?:written )?(?:permission|consent)", "reproduced|copied|redistributed", 0.5),
    ("copyright-notice", r"copyright (?:c )?(?:19|20)\d\d", "copyright", 0.2),
    ("warranty-disclaimer", r"the software is provided as is without warranty of any kind", "warranty", 0.5),
    ("warranty-disclaimer", r"including but not limited to the (?:implied )?warranties of merchantability", "merchantability", 0.4),
    ("warranty-disclaimer", r"in no event shall (?:\S+ ){1,16}be liable for any", "liable", 0.4),
)


def rules() -> list[tuple[int, str, str, str, float]]:
    """(priority, label, keyword, pattern over lower-case words between single spaces, weight), the most telling first."""
    n = count()
    out = [(next(n), label, keyword, rf"(?<= )(?:{form.format(n=name, s=short)})(?= )", weight) for form, weight in FORMS for label, (name, short, keyword) in FAMILIES.items()]
    out += [(next(n), label, "spdx", rf"(?<= )(?:{EXPRESSION.format(s=short)})(?= )", EXPRESSION_WEIGHT) for label, (_, short, _) in FAMILIES.items()]
    return out + [(next(n), label, keyword, rf"(?<= )(?:{pattern})(?= )", weight) for label, pattern, keyword, weight in (*SHORT, *SENTENCES)]


def _ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _words(text: Column) -> Column:
    """The text's words in lower case, one space before, between and after them."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(_ascii_lower(text), BETWEEN, " ")), F.lit(" "))


PLACE, DETECTION = "struct<start:int,end:int>", "struct<start:int,backward:int,priority:int,label:string,weight:double>"


def _spans(words: Column, pattern: Column) -> Column:
    """Array of (start, end) in words, from 0, end exclusive, of the pattern's places, from left to right.

    What splitting at the pattern leaves and what matches, in turns, make up the text; words are told by the spaces before them.
    """
    spaces = lambda c: F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))
    turns = F.arrays_zip(F.split(words, pattern, -1).alias("rest"), F.regexp_extract_all(words, pattern, F.lit(0)).alias("found"))
    begin = lambda at, x: at + spaces(x["rest"])
    end = lambda at, x: begin(at, x) + F.coalesce(spaces(x["found"]), F.lit(0))
    place = lambda at, x: F.when(x["found"].isNotNull(), F.struct((begin(at, x) - 1).alias("start"), end(at, x).alias("end")))
    return F.array_compact(running(turns, end, place, f"array<{PLACE}>"))


def _settle(found: Column) -> Column:
    """What stays of detections: one that lies within another goes (of equal places all but the first by priority); the rest are taken by
    priority, then by start, and one that overlaps none taken before stays.

    Sorted by start, what lies in nothing has rising ends as well. So it falls into stretches that don't touch, and each is settled alone.
    """
    none = F.array().cast(f"array<{DETECTION}>")
    whole = F.array_compact(running(F.array_sort(found), lambda at, x: F.greatest(at, -x["backward"]), lambda at, x: F.when(-x["backward"] > at, x), f"array<{DETECTION}>"))
    by_priority = lambda part: F.transform(F.array_sort(F.transform(part, lambda x: F.struct(x["priority"].alias("p"), x.alias("x")))), lambda y: y["x"])
    apart = lambda x, y: (x["start"] >= -y["backward"]) | (y["start"] >= -x["backward"])

    def taken(part: Column) -> Column:
        fold = lambda own: F.aggregate(by_priority(own), none, lambda kept, x: F.when(F.forall(kept, lambda y: apart(x, y)), F.concat(kept, F.array(x))).otherwise(kept))
        return F.when(F.size(part) > 1, fold(part)).otherwise(part)

    def stretches(c: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(c) - 1)
        firsts = F.filter(places, lambda i: (i == 0) | (F.get(c, i)["start"] >= -F.get(c, F.greatest(i - 1, F.lit(0)))["backward"]))
        return bound(F.concat(firsts, F.array(F.size(c))), lambda f: F.transform(F.sequence(F.lit(0), F.size(f) - 2), lambda k: F.slice(c, F.get(f, k) + 1, F.get(f, k + 1) - F.get(f, k))))

    settled = lambda c: F.when(F.size(c) > 0, F.array_sort(F.flatten(F.transform(stretches(c), taken)))).otherwise(none)
    return bound(whole, settled)


def gate() -> list[str]:
    """Words of which every text with a base place or a rule's place holds one: the rules' keywords and the base phrases' common word."""
    return sorted({k for _, _, keyword, _, _ in rules() for k in keyword.split("|")} | {"license"})


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections for every row.

    Null texts count as empty: no word, no place, empty labels, score 0. Repeated rows give repeated results, an empty table no row.
    A text is gated twice: by all rules' keywords, then each rule by its own. score: the weight of the best rule that stays, 0.75 for a base place
    alone. Each row is worked on where it lies; nothing is joined or shuffled.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    parts = F.split(F.lower("text"), BETWEEN[:-1] + "++")  # only the first and the last may be empty; lower() does more than A-Z, which lets more through
    empty = lambda part: F.when(part == "", 1).otherwise(0)
    own = own.select("doc_id", "text", parts.alias("parts"))
    n_words = F.size("parts") - empty(F.get("parts", 0)) - F.when(F.size("parts") > 1, empty(F.element_at("parts", -1))).otherwise(0)
    own = own.select("doc_id", n_words.cast("long").alias("n_words"), F.when(F.arrays_overlap("parts", F.lit(gate())), _words(F.col("text"))).alias("words"))
    base = F.array(*[F.struct(F.lit(label).alias("label"), _spans(F.col("words"), F.lit(f"(?<= ){phrase}(?= )")).alias("at")) for phrase, label in BASE])
    gated = F.col("words").contains(" license ")
    own = own.withColumn("base", F.when(gated, base).otherwise(F.array().cast(f"array<struct<label:string,at:array<{PLACE}>>>")))
    given = rules()
    by_keyword: dict[str, list[Column]] = {}
    for p, _, keyword, pattern, _ in given:
        by_keyword.setdefault(keyword, []).append(F.when(F.col("words").rlike(pattern), F.lit(p)))
    held = lambda keyword: reduce(or_, [F.col("words").contains(f" {k} ") for k in keyword.split("|")])
    none = F.array().cast("array<int>")
    fires = F.array_compact(F.flatten(F.array(*[F.when(held(k), F.array(*own_rules)).otherwise(none) for k, own_rules in by_keyword.items()])))
    own = own.withColumn("fires", F.when(F.col("words").isNotNull(), fires).otherwise(none))
    known = F.array(*[F.struct(F.lit(label).alias("label"), F.lit(pattern).alias("pattern"), F.lit(w).alias("weight")) for _, label, _, pattern, w in given])

    def places(p: Column) -> Column:
        rule = F.element_at(known, p + 1)
        detection = lambda x: F.struct(x["start"].alias("start"), (-x["end"]).alias("backward"), p.alias("priority"), rule["label"].alias("label"), rule["weight"].alias("weight"))
        return F.transform(_spans(F.col("words"), rule["pattern"]), detection)

    own = own.withColumn("stay", F.when(F.size("fires") > 0, _settle(F.flatten(F.transform("fires", places)).cast(f"array<{DETECTION}>"))).otherwise(F.array().cast(f"array<{DETECTION}>")))
    starts = F.flatten(F.transform("base", lambda b: F.transform(b["at"], lambda x: x["start"])))
    with_place = F.transform(F.filter("base", lambda b: F.size(b["at"]) > 0), lambda b: b["label"])
    return own.select("doc_id", "n_words", starts.alias("starts"), with_place.alias("based"), "stay").select(
        "doc_id",
        "n_words",
        F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"),
        F.array_max("starts").cast("long").alias("last_word"),
        F.array_join(F.array_sort("based"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("based", F.transform("stay", lambda x: x["label"]))), ",").alias("labels"),
        F.greatest(F.when(F.size("starts") > 0, F.lit(0.75)).otherwise(F.lit(0.0)), F.coalesce(F.array_max(F.transform("stay", lambda x: x["weight"])), F.lit(0.0))).alias("score"),
        F.transform("stay", lambda x: F.struct(x["label"].alias("label"), x["start"].alias("start"), (-x["backward"]).alias("end"), x["weight"].alias("weight"))).alias("detections"),
    )
