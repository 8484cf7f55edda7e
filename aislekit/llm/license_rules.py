"""Signature rules of the license scan, written by hand.

One rule a line: priority, label, regular expression over the words of a text
(lower case, one space between words).  The word in <> is the rule's rarest
literal; it has to stand in a text before the expression is tried.  {v2.1}
stands for a version, {later} for "or any later version", {lic} for either
spelling of license.  Groups are optional words or lists of alternatives, so a
match spans at most REACH words on either side of its literal.

Priority 4 names a license with its version or identifier, 3 a license,
2 a passage of a license text, 1 a hint.  The lines of priority 0 are the
base phrases: their matches are never suppressed.
"""

from __future__ import annotations

import re
from typing import NamedTuple

REACH = 24

RULES_TEXT = """
0 cc-by <cc> by
0 gpl general public <license>
0 reserved all rights <reserved>

4 apache-2.0 (?:licensed )?(?:under )?(?:the )?<apache> {lic}{v2.0}
4 apache-2.0 <apache>{v2.0}(?: {lic})?
4 apache-2.0 spdx {lic} identifier <apache> 2 0
4 apache-2.0 www <apache> org licenses license 2 0
4 apache-1.1 (?:the )?<apache> (?:software )?{lic}{v1.1}
4 apache-1.0 (?:the )?<apache> (?:software )?{lic}{v1.0}
3 apache (?:licensed )?(?:under )?(?:the )?<apache> (?:software )?{lic}
3 apache <apache> software foundation
2 apache-2.0 you may not use this file except in <compliance> with the {lic}
2 apache-2.0 distributed on an as is basis without warranties or <conditions> of any kind
1 apache <apache> licensed

4 mit (?:spdx )?{lic} <identifier> mit
3 mit (?:released |licensed |distributed )?(?:under )?(?:the )?mit <license>
3 mit (?:released |licensed |distributed )?(?:under )?(?:the )?mit <licence>
3 mit (?:the )?mit x11 <license>
3 mit (?:the )?expat <license>
3 mit <licensed> under (?:the )?(?:terms of )?(?:the )?mit
3 mit opensource org <licenses> mit
2 mit permission is hereby <granted> free of charge to any person obtaining a copy
2 mit to use copy modify merge publish distribute <sublicense> and or sell copies
2 mit the above <copyright> notice and this permission notice shall be included
2 mit-0 mit no attribution <license>
3 x11 (?:the )?x11 <license>
3 x11 x <consortium> {lic}

4 bsd-0-clause (?:bsd )?zero <clause> bsd(?: {lic})?
4 bsd-0-clause 0 <clause> bsd(?: {lic})?
4 bsd-0-clause bsd 0 <clause>
4 bsd-1-clause bsd 1 <clause>
4 bsd-2-clause bsd 2 <clause>
4 bsd-2-clause 2 <clause> bsd(?: {lic})?
4 bsd-2-clause two <clause> bsd(?: {lic})?
4 bsd-2-clause (?:the )?<simplified> bsd {lic}
4 bsd-2-clause (?:the )?<freebsd> {lic}
4 bsd-3-clause bsd 3 <clause>
4 bsd-3-clause 3 <clause> bsd(?: {lic})?
4 bsd-3-clause three <clause> bsd(?: {lic})?
4 bsd-3-clause (?:the )?new bsd <license>
4 bsd-3-clause (?:the )?modified bsd <license>
4 bsd-3-clause (?:the )?revised bsd <license>
4 bsd-4-clause bsd 4 <clause>
4 bsd-4-clause 4 <clause> bsd(?: {lic})?
4 bsd-4-clause four <clause> bsd(?: {lic})?
4 bsd-4-clause (?:the )?original bsd <license>
3 bsd (?:released |licensed |distributed )?(?:under )?(?:the |a )?bsd(?: style)? <license>
3 bsd (?:released |licensed |distributed )?(?:under )?(?:the |a )?bsd(?: style)? <licence>
3 bsd (?:the )?berkeley software distribution <license>
2 bsd <redistribution> and use in source and binary forms with or without modification
2 bsd <redistributions> of source code must retain the above copyright notice
2 bsd <redistributions> in binary form must reproduce the above copyright notice
2 bsd-3-clause neither the name of [^ ]+(?: [^ ]+)?(?: [^ ]+)? nor the names of its <contributors>
2 bsd-4-clause all <advertising> materials mentioning features or use of this software

4 gpl-1.0 (?:gnu )?general public <license>{v1.0}{later}
4 gpl-2.0 (?:gnu )?general public <license>{v2.0}{later}
4 gpl-3.0 (?:under )?(?:the )?(?:gnu )?general public <license>{v3.0}{later}
4 gpl-2.0 (?:gnu )?general public <licence>{v2.0}{later}
4 gpl-3.0 (?:gnu )?general public <licence>{v3.0}{later}
4 gpl-1.0 <gpl>{v1.0}{later}
4 gpl-2.0 (?:gnu )?<gpl>{v2.0}{later}
4 gpl-3.0 (?:gnu )?<gpl>{v3.0}{later}
4 gpl-2.0 <gplv2>{later}
4 gpl-3.0 <gplv3>{later}
4 gpl-2.0 <gpl2>{later}
4 gpl-3.0 <gpl3>{later}
4 gpl-2.0-only <gpl> 2 0 only
4 gpl-2.0-or-later <gpl> 2 0 or later
4 gpl-3.0-only <gpl> 3 0 only
4 gpl-3.0-or-later <gpl> 3 0 or later
4 gpl-2.0-classpath <gpl> 2 0 with classpath exception(?: 2 0)?
4 gpl-classpath <classpath> exception
4 gpl-linking gcc <runtime> library exception
3 gpl (?:licensed |released |distributed )?(?:under )?(?:the )?(?:terms of the )?(?:gnu )?general public <license>
3 gpl (?:licensed |released |distributed )?(?:under )?(?:the )?(?:terms of the )?(?:gnu )?general public <licence>
3 gpl (?:gnu )?<gpl>(?: {lic}| licensed)?
3 gpl www <gnu> org (?:licenses|copyleft) gpl(?: html| txt)?
2 gpl this program is free software you can <redistribute> it and or modify it
2 gpl you should have received a copy of the <gnu> general public {lic}
2 gpl without even the implied warranty of <merchantability> or fitness for a particular purpose
2 gpl either version [0-9] of the <license> or at your option any later version

4 lgpl-2.0 (?:gnu )?library general public <license>{v2.0}{later}
4 lgpl-2.1 (?:gnu )?lesser general public <license>{v2.1}{later}
4 lgpl-3.0 (?:gnu )?lesser general public <license>{v3.0}{later}
4 lgpl-2.0 (?:gnu )?<lgpl>{v2.0}{later}
4 lgpl-2.1 (?:gnu )?<lgpl>{v2.1}{later}
4 lgpl-3.0 (?:gnu )?<lgpl>{v3.0}{later}
4 lgpl-2.1 <lgplv2> 1{later}
4 lgpl-2.1 <lgplv2>{later}
4 lgpl-3.0 <lgplv3>{later}
4 lgpl-2.1-only <lgpl> 2 1 only
4 lgpl-2.1-or-later <lgpl> 2 1 or later
4 lgpl-3.0-only <lgpl> 3 0 only
4 lgpl-3.0-or-later <lgpl> 3 0 or later
3 lgpl (?:gnu )?lesser general public <license>
3 lgpl (?:gnu )?library general public <license>
3 lgpl (?:gnu )?<lgpl>(?: {lic})?

4 agpl-1.0 affero general public <license>{v1.0}{later}
4 agpl-3.0 (?:gnu )?affero general public <license>{v3.0}{later}
4 agpl-3.0 (?:gnu )?<agpl>{v3.0}{later}
4 agpl-3.0 <agplv3>{later}
4 agpl-3.0-only <agpl> 3 0 only
4 agpl-3.0-or-later <agpl> 3 0 or later
3 agpl (?:gnu )?<affero> general public {lic}
3 agpl (?:gnu )?<agpl>(?: {lic})?
4 gfdl-1.1 (?:gnu )?free documentation <license>{v1.1}{later}
4 gfdl-1.2 (?:gnu )?free documentation <license>{v1.2}{later}
4 gfdl-1.3 (?:gnu )?free documentation <license>{v1.3}{later}
3 gfdl (?:gnu )?free documentation <license>
3 gfdl <gfdl>(?: [0-9] [0-9])?
2 gfdl with no <invariant> sections no front cover texts and no back cover texts

4 mpl-1.0 (?:the )?<mozilla> public {lic}{v1.0}
4 mpl-1.1 (?:the )?<mozilla> public {lic}{v1.1}
4 mpl-2.0 (?:the )?<mozilla> public {lic}{v2.0}
4 mpl-1.0 <mpl>{v1.0}
4 mpl-1.1 <mpl>{v1.1}
4 mpl-2.0 <mpl>{v2.0}
3 mpl (?:the )?<mozilla> public {lic}
2 mpl-2.0 this source code form is subject to the terms of the <mozilla> public {lic}
4 epl-1.0 (?:the )?<eclipse> public {lic}{v1.0}
4 epl-2.0 (?:the )?<eclipse> public {lic}{v2.0}
4 epl-1.0 <epl>{v1.0}
4 epl-2.0 <epl>{v2.0}
3 epl (?:the )?<eclipse> public {lic}
4 edl-1.0 <eclipse> distribution {lic}{v1.0}
3 edl <eclipse> distribution {lic}
4 cddl-1.0 common development and <distribution> {lic}{v1.0}
4 cddl-1.1 common development and <distribution> {lic}{v1.1}
4 cddl-1.0 <cddl>{v1.0}
4 cddl-1.1 <cddl>{v1.1}
3 cddl common development and <distribution> {lic}
3 cddl <cddl>(?: {lic})?
4 cpl-1.0 common public <license>{v1.0}
3 cpl common public <license>
4 ipl-1.0 ibm public <license>{v1.0}
3 ipl ibm public <license>
4 eupl-1.1 european union public <licence>{v1.1}
4 eupl-1.2 european union public <licence>{v1.2}
4 eupl-1.1 <eupl>{v1.1}
4 eupl-1.2 <eupl>{v1.2}
3 eupl european union public <licence>
3 eupl <eupl>
4 cecill-2.1 <cecill>{v2.1}
4 cecill-b <cecill> b
4 cecill-c <cecill> c
3 cecill <cecill>(?: {lic}| free software {lic}(?: agreement)?)?
4 osl-3.0 open software <license>{v3.0}
3 osl open software <license>
4 afl-3.0 academic free <license>{v3.0}
3 afl academic free <license>
4 artistic-1.0 (?:the )?<artistic> {lic}{v1.0}
4 artistic-2.0 (?:the )?<artistic> {lic}{v2.0}
3 artistic (?:the )?<artistic> {lic}
4 ms-pl microsoft public <license>
4 ms-rl microsoft reciprocal <license>
4 ms-lpl microsoft limited public <license>

4 cc0-1.0 <cc0>{v1.0}(?: universal)?
3 cc0 <cc0>
3 cc0 creative <commons> zero
4 cc0-1.0 creativecommons org <publicdomain> zero 1 0
4 cc-pdm <publicdomain> mark 1 0
4 cc-by-1.0 <cc> by{v1.0}
4 cc-by-2.0 <cc> by{v2.0}
4 cc-by-2.5 <cc> by{v2.5}
4 cc-by-3.0 <cc> by{v3.0}
4 cc-by-4.0 <cc> by{v4.0}
4 cc-by-sa-2.0 <cc> by sa{v2.0}
4 cc-by-sa-2.5 <cc> by sa{v2.5}
4 cc-by-sa-3.0 <cc> by sa{v3.0}
4 cc-by-sa-4.0 <cc> by sa{v4.0}
4 cc-by-nc-2.0 <cc> by nc{v2.0}
4 cc-by-nc-3.0 <cc> by nc{v3.0}
4 cc-by-nc-4.0 (?:licensed )?(?:under )?<cc> by nc{v4.0}
4 cc-by-nd-3.0 <cc> by nd{v3.0}
4 cc-by-nd-4.0 <cc> by nd{v4.0}
4 cc-by-nc-sa-3.0 <cc> by nc sa{v3.0}
4 cc-by-nc-sa-4.0 <cc> by nc sa{v4.0}
4 cc-by-nc-nd-3.0 <cc> by nc nd{v3.0}
4 cc-by-nc-nd-4.0 <cc> by nc nd{v4.0}
3 cc-by-sa <cc> by sa
3 cc-by-nc <cc> by nc
3 cc-by-nd <cc> by nd
3 cc-by-nc-sa <cc> by nc sa
3 cc-by-nc-nd <cc> by nc nd
3 cc-by <cc> by
4 cc-by-4.0 creative <commons> attribution(?: {lic})?{v4.0}(?: international)?(?: {lic})?
4 cc-by-3.0 creative <commons> attribution(?: {lic})?{v3.0}(?: unported)?(?: {lic})?
4 cc-by-sa-4.0 creative <commons> attribution share ?alike{v4.0}(?: international)?(?: {lic})?
4 cc-by-sa-3.0 creative <commons> attribution share ?alike{v3.0}(?: unported)?(?: {lic})?
4 cc-by-nc-4.0 creative <commons> attribution non ?commercial{v4.0}(?: international)?(?: {lic})?
4 cc-by-nd-4.0 creative <commons> attribution no ?deriv(?:ative)?s{v4.0}(?: international)?(?: {lic})?
4 cc-by-nc-sa-4.0 creative <commons> attribution non ?commercial share ?alike{v4.0}(?: international)?(?: {lic})?
4 cc-by-nc-nd-4.0 creative <commons> attribution non ?commercial no ?deriv(?:ative)?s{v4.0}(?: international)?(?: {lic})?
3 cc-by-sa creative <commons> attribution share ?alike
3 cc-by-nc creative <commons> attribution non ?commercial
3 cc-by creative <commons> attribution
4 cc-by-4.0 <creativecommons> org licenses by 4 0
4 cc-by-3.0 <creativecommons> org licenses by 3 0
4 cc-by-sa-4.0 <creativecommons> org licenses by sa 4 0
4 cc-by-sa-3.0 <creativecommons> org licenses by sa 3 0
4 cc-by-nc-4.0 <creativecommons> org licenses by nc 4 0
4 cc-by-nd-4.0 <creativecommons> org licenses by nd 4 0
4 cc-by-nc-sa-4.0 <creativecommons> org licenses by nc sa 4 0
4 cc-by-nc-nd-4.0 <creativecommons> org licenses by nc nd 4 0
2 creative-commons creative <commons>(?: {lic})?
2 creative-commons <creativecommons> org(?: licenses)?

3 isc (?:the )?isc <license>
3 isc (?:the )?isc <licence>
2 isc permission to use copy modify and or distribute this software for any purpose with or without fee is hereby <granted>
4 bsl-1.0 (?:the )?boost software <license>{v1.0}
3 bsl (?:the )?boost software <license>
3 zlib (?:the )?<zlib> (?:libpng )?{lic}
2 zlib the origin of this software must not be <misrepresented>
3 libpng <libpng> {lic}
3 unlicense (?:the )?<unlicense>
2 unlicense this is free and <unencumbered> software released into the public domain
3 wtfpl <wtfpl>
3 wtfpl do what the fuck you want to public <license>
3 beerware (?:the )?<beerware>(?: {lic})?
3 beerware beer ware <license>
4 psf-2.0 python software foundation <license>{v2.0}
3 psf python software foundation <license>
3 psf <psf> {lic}
3 php php <license>(?: version)?(?: [0-9] [0-9]+)?
3 ruby ruby <license>
3 perl same terms as <perl>(?: itself)?
3 openssl <openssl> {lic}
3 ssleay <ssleay> {lic}
3 postgresql (?:the )?<postgresql> {lic}
3 ncsa university of illinois ncsa open source <license>
3 ncsa <ncsa> {lic}
3 ntp <ntp> {lic}
3 hpnd historical permission <notice> and disclaimer
3 curl curl <license>
3 imagemagick <imagemagick> {lic}
3 vim vim <license>
3 json json <license>
2 json shall be used for good not <evil>
3 w3c w3c software(?: notice and)? <license>
3 unicode unicode <license>(?: v3| agreement)?
3 icu icu <license>
3 freetype <freetype>(?: project)? {lic}
3 ijg independent jpeg <group>
3 sleepycat <sleepycat> {lic}
3 qpl q public <license>
3 watcom sybase open <watcom> public {lic}
3 zpl zope public <license>
3 upl universal permissive <license>
4 upl-1.0 universal permissive <license>{v1.0}
3 blueoak blue oak model <license>
3 mulan <mulan> (?:psl|permissive software {lic})
3 elastic (?:the )?elastic <license>(?:{v2.0})?
3 sspl server side public <license>
3 sspl <sspl>
3 bsl-business business source <license>(?:{v1.1})?
3 commons-clause commons <clause>(?: {lic})?
3 polyform <polyform> (?:noncommercial|shield|strict|small business|free trial)(?: {lic})?
4 ofl-1.1 (?:sil )?open font <license>{v1.1}
3 ofl (?:sil )?open font <license>
4 ofl-1.1 <ofl>{v1.1}
3 ubuntu-font ubuntu font <licence>
4 odbl-1.0 open database <license>{v1.0}
3 odbl open database <license>
3 odbl <odbl>
3 odc-by open data commons <attribution>(?: {lic})?
3 pddl public domain <dedication> and {lic}
3 ogl-uk open government <licence>(?:{v3.0})?
3 etalab <etalab>(?: 2 0)?
3 openrail <openrail>(?: m)?
3 rail responsible ai <license>
3 llama llama [0-9] (?:[0-9] )?community <license>
3 llama llama community <license>
3 gemma gemma terms of <use>

4 spdx spdx <license> identifier
4 spdx <spdx>(?: {lic})?
2 public-domain (?:released |placed |dedicated )?(?:in |into |to )?(?:the )?public <domain>
2 public-domain no <copyright>(?: is)?(?: claimed)?
2 reserved all rights <reserved>
2 reserved tous droits <réservés>
2 reserved alle rechte <vorbehalten>
2 reserved todos los derechos <reservados>
2 some-reserved some rights <reserved>
2 proprietary (?:this (?:software|document) is )?<proprietary> and confidential
2 proprietary <proprietary> {lic}
2 proprietary unauthorized (?:copying|reproduction|distribution|use) (?:of this file )?(?:is )?strictly <prohibited>
2 proprietary may not be reproduced <distributed> or transmitted
2 proprietary end user <license> agreement
2 proprietary <eula>
2 non-commercial for non ?commercial (?:use|purposes) <only>
2 non-commercial <noncommercial> use only
2 no-derivatives no <derivatives>(?: allowed)?
2 as-is (?:provided )?as is without <warranty> of any kind
2 as-is without <warranty>(?: of any kind)?(?: express or implied)?
2 as-is in no event shall the (?:authors|author|copyright holders?) [^ ]+ <liable>
2 as-is in no event shall the (?:authors|author) or copyright holders be <liable>
2 trademark (?:is a )?registered <trademark>
2 trademark all <trademarks> are the property of their respective owners
2 patent patent <pending>
2 dual-license dual <licensed>(?: under)?
2 copyleft <copyleft>
1 copyright <copyright>(?: c| ©)? (?:19|20)[0-9][0-9](?: (?:19|20)[0-9][0-9])?
1 copyright <copyright>(?: holders?| owners?| notice)?
1 copyright <copyrighted>(?: by| material)?
1 license (?:released |licensed |distributed )?under (?:the |an? )?(?:[^ ]+ )?<license>
1 license (?:released |licensed |distributed )?under (?:the |an? )?(?:[^ ]+ )?<licence>
1 license <licensed> under
1 license <licensed>
1 license <license>(?: agreement| terms| file| text| notice)?
1 license <licence>(?: agreement| terms| file| text| notice)?
1 license <licenses>
1 license <licensor>
1 license <licensee>
1 license <sublicense>
1 open-source open source <software>
1 permission <permission>(?: is)?(?: hereby)? granted
1 permission used by <permission>
1 permission with <permission>(?: of| from)
"""


class Rule(NamedTuple):
    rule: int
    priority: int
    label: str
    key: str
    left: str
    right: str


def _spelt(pattern: str) -> str:
    """``pattern`` with its named parts written out; {v2.0} also fits "version 2", "v2" and "v2 0"."""
    def version(m: re.Match) -> str:
        major, minor = m[1], m[2]
        tail = "(?: 0)?" if minor == "0" else f" {minor}"
        return f"(?:(?: version| v)? {major}| v{major}){tail}"

    pattern = re.sub(r"\{v(\d)\.(\d)\}", version, pattern)
    return pattern.replace("{later}", "(?: or(?: any)? later(?: version)?)?").replace("{lic}", "licen[sc]e")


def parse(text: str) -> list[Rule]:
    """Rules of a rules text, numbered in order."""
    out = []
    for line in filter(None, map(str.strip, text.splitlines())):
        priority, label, pattern = line.split(" ", 2)
        left, key, right = re.fullmatch(r"([^<>]*?)<([^<> ]+)>([^<>]*)", pattern).groups()
        out.append(Rule(len(out), int(priority), label, key, _spelt(left), _spelt(right)))
    return out


RULES = parse(RULES_TEXT)
