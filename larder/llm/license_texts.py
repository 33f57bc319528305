"""Wording of whole licences, as templates of the licence scan.

The words are the licences' own, lower-cased and without marks. Numbers and letters of
clauses may be absent or, in the short licences, of any kind; names of holders may be
any words; notices before and appendices after the conditions are no part of them.
"""

from __future__ import annotations

# fixed values: the licences' wording
MIT = """
permission is hereby granted free of charge to any person obtaining a copy of this software and associated
documentation files the software to deal in the software without restriction including without limitation the
rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit
persons to whom the software is furnished to do so subject to the following conditions the above copyright
notice and this permission notice <<opt: including the next paragraph >> shall be included in all copies or
substantial portions of the software the software is provided as is without warranty of any kind express or
implied including but not limited to the warranties of merchantability fitness for a particular purpose and
noninfringement in no event shall the <<any: 8 >> be liable for any claim damages or other liability whether in
an action of contract tort or otherwise arising from out of or in connection with the software or the use or
other dealings in the software
"""

ISC = """
permission to use copy modify and <<opt: or >> distribute this software for any purpose with or without fee is
hereby granted provided that the above copyright notice and this permission notice appear in all copies the
software is provided as is and <<any: 8 >> disclaims all warranties with regard to this software including all
implied warranties of merchantability and fitness in no event shall <<any: 8 >> be liable for any special direct
indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether
in an action of contract negligence or other tortious action arising out of or in connection with the use or
performance of this software
"""

BSD_CONDITIONS = """
redistribution and use in source and binary forms with or without modification are permitted provided that the
following conditions are met <<any: 1 >> redistributions of source code must retain the above copyright notice
this list of conditions and the following disclaimer <<any: 1 >> redistributions in binary form must reproduce
the above copyright notice this list of conditions and the following disclaimer in the documentation and or
other materials provided with the distribution
"""

BSD_ADVERTISING = """
<<any: 1 >> all advertising materials mentioning features or use of this software must display the following
<<any: 1 >> this product includes software developed by <<any: 24 >>
"""

BSD_NAMES = """
<<any: 1 >> neither the name of <<any: 12 >> nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission
"""

BSD_DISCLAIMER = """
this software is provided by <<any: 12 >> as is and any express or implied warranties including but not limited
to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event
shall <<any: 12 >> be liable for any direct indirect incidental special exemplary or consequential damages
including but not limited to procurement of substitute goods or services loss of use data or profits or business
interruption however caused and on any theory of liability whether in contract strict liability or tort
including negligence or otherwise arising in any way out of the use of this software even if advised of the
possibility of such damage
"""

APACHE_2 = """
apache license version 2 0 <<opt: january 2004 >> <<opt: http www apache org licenses >> terms and conditions
for use reproduction and distribution <<opt: 1 >> definitions license shall mean the terms and conditions for
use reproduction and distribution as defined by sections 1 through 9 of this document licensor shall mean the
copyright owner or entity authorized by the copyright owner that is granting the license legal entity shall mean
the union of the acting entity and all other entities that control are controlled by or are under common control
with that entity for the purposes of this definition control means i the power direct or indirect to cause the
direction or management of such entity whether by contract or otherwise or ii ownership of fifty percent 50 or
more of the outstanding shares or iii beneficial ownership of such entity you or your shall mean an individual
or legal entity exercising permissions granted by this license source form shall mean the preferred form for
making modifications including but not limited to software source code documentation source and configuration
files object form shall mean any form resulting from mechanical transformation or translation of a source form
including but not limited to compiled object code generated documentation and conversions to other media types
work shall mean the work of authorship whether in source or object form made available under the license as
indicated by a copyright notice that is included in or attached to the work an example is provided in the
appendix below derivative works shall mean any work whether in source or object form that is based on or derived
from the work and for which the editorial revisions annotations elaborations or other modifications represent as
a whole an original work of authorship for the purposes of this license derivative works shall not include works
that remain separable from or merely link or bind by name to the interfaces of the work and derivative works
thereof contribution shall mean any work of authorship including the original version of the work and any
modifications or additions to that work or derivative works thereof that is intentionally submitted to licensor
for inclusion in the work by the copyright owner or by an individual or legal entity authorized to submit on
behalf of the copyright owner for the purposes of this definition submitted means any form of electronic verbal
or written communication sent to the licensor or its representatives including but not limited to communication
on electronic mailing lists source code control systems and issue tracking systems that are managed by or on
behalf of the licensor for the purpose of discussing and improving the work but excluding communication that is
conspicuously marked or otherwise designated in writing by the copyright owner as not a contribution contributor
shall mean licensor and any individual or legal entity on behalf of whom a contribution has been received by
licensor and subsequently incorporated within the work <<opt: 2 >> grant of copyright license subject to the
terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non exclusive
no charge royalty free irrevocable copyright license to reproduce prepare derivative works of publicly display
publicly perform sublicense and distribute the work and such derivative works in source or object form <<opt: 3
>> grant of patent license subject to the terms and conditions of this license each contributor hereby grants to
you a perpetual worldwide non exclusive no charge royalty free irrevocable except as stated in this section
patent license to make have made use offer to sell sell import and otherwise transfer the work where such
license applies only to those patent claims licensable by such contributor that are necessarily infringed by
their contribution s alone or by combination of their contribution s with the work to which such contribution s
was submitted if you institute patent litigation against any entity including a cross claim or counterclaim in a
lawsuit alleging that the work or a contribution incorporated within the work constitutes direct or contributory
patent infringement then any patent licenses granted to you under this license for that work shall terminate as
of the date such litigation is filed <<opt: 4 >> redistribution you may reproduce and distribute copies of the
work or derivative works thereof in any medium with or without modifications and in source or object form
provided that you meet the following conditions <<opt: a >> you must give any other recipients of the work or
derivative works a copy of this license and <<opt: b >> you must cause any modified files to carry prominent
notices stating that you changed the files and <<opt: c >> you must retain in the source form of any derivative
works that you distribute all copyright patent trademark and attribution notices from the source form of the
work excluding those notices that do not pertain to any part of the derivative works and <<opt: d >> if the work
includes a notice text file as part of its distribution then any derivative works that you distribute must
include a readable copy of the attribution notices contained within such notice file excluding those notices
that do not pertain to any part of the derivative works in at least one of the following places within a notice
text file distributed as part of the derivative works within the source form or documentation if provided along
with the derivative works or within a display generated by the derivative works if and wherever such third party
notices normally appear the contents of the notice file are for informational purposes only and do not modify
the license you may add your own attribution notices within derivative works that you distribute alongside or as
an addendum to the notice text from the work provided that such additional attribution notices cannot be
construed as modifying the license you may add your own copyright statement to your modifications and may
provide additional or different license terms and conditions for use reproduction or distribution of your
modifications or for any such derivative works as a whole provided your use reproduction and distribution of the
work otherwise complies with the conditions stated in this license <<opt: 5 >> submission of contributions
unless you explicitly state otherwise any contribution intentionally submitted for inclusion in the work by you
to the licensor shall be under the terms and conditions of this license without any additional terms or
conditions notwithstanding the above nothing herein shall supersede or modify the terms of any separate license
agreement you may have executed with licensor regarding such contributions <<opt: 6 >> trademarks this license
does not grant permission to use the trade names trademarks service marks or product names of the licensor
except as required for reasonable and customary use in describing the origin of the work and reproducing the
content of the notice file <<opt: 7 >> disclaimer of warranty unless required by applicable law or agreed to in
writing licensor provides the work and each contributor provides its contributions on an as is basis without
warranties or conditions of any kind either express or implied including without limitation any warranties or
conditions of title non infringement merchantability or fitness for a particular purpose you are solely
responsible for determining the appropriateness of using or redistributing the work and assume any risks
associated with your exercise of permissions under this license <<opt: 8 >> limitation of liability in no event
and under no legal theory whether in tort including negligence contract or otherwise unless required by
applicable law such as deliberate and grossly negligent acts or agreed to in writing shall any contributor be
liable to you for damages including any direct indirect special incidental or consequential damages of any
character arising as a result of this license or out of the use or inability to use the work including but not
limited to damages for loss of goodwill work stoppage computer failure or malfunction or any and all other
commercial damages or losses even if such contributor has been advised of the possibility of such damages <<opt:
9 >> accepting warranty or additional liability while redistributing the work or derivative works thereof you
may choose to offer and charge a fee for acceptance of support warranty indemnity or other liability obligations
and or rights consistent with this license however in accepting such obligations you may act only on your own
behalf and on your sole responsibility not on behalf of any other contributor and only if you agree to indemnify
defend and hold each contributor harmless for any liability incurred by or claims asserted against such
contributor by reason of your accepting any such warranty or additional liability end of terms and conditions
"""

MPL_2 = """
mozilla public license version 2 0 <<opt: 1 >> definitions <<opt: 1 1 >> contributor means each individual or
legal entity that creates contributes to the creation of or owns covered software <<opt: 1 2 >> contributor
version means the combination of the contributions of others if any used by a contributor and that particular
contributor s contribution <<opt: 1 3 >> contribution means covered software of a particular contributor <<opt:
1 4 >> covered software means source code form to which the initial contributor has attached the notice in
exhibit a the executable form of such source code form and modifications of such source code form in each case
including portions thereof <<opt: 1 5 >> incompatible with secondary licenses means <<opt: a >> that the initial
contributor has attached the notice described in exhibit b to the covered software or <<opt: b >> that the
covered software was made available under the terms of version 1 1 or earlier of the license but not also under
the terms of a secondary license <<opt: 1 6 >> executable form means any form of the work other than source code
form <<opt: 1 7 >> larger work means a work that combines covered software with other material in a separate
file or files that is not covered software <<opt: 1 8 >> license means this document <<opt: 1 9 >> licensable
means having the right to grant to the maximum extent possible whether at the time of the initial grant or
subsequently any and all of the rights conveyed by this license <<opt: 1 10 >> modifications means any of the
following <<opt: a >> any file in source code form that results from an addition to deletion from or
modification of the contents of covered software or <<opt: b >> any new file in source code form that contains
any covered software <<opt: 1 11 >> patent claims of a contributor means any patent claim s including without
limitation method process and apparatus claims in any patent licensable by such contributor that would be
infringed but for the grant of the license by the making using selling offering for sale having made import or
transfer of either its contributions or its contributor version <<opt: 1 12 >> secondary license means either
the gnu general public license version 2 0 the gnu lesser general public license version 2 1 the gnu affero
general public license version 3 0 or any later versions of those licenses <<opt: 1 13 >> source code form means
the form of the work preferred for making modifications <<opt: 1 14 >> you or your means an individual or a
legal entity exercising rights under this license for legal entities you includes any entity that controls is
controlled by or is under common control with you for purposes of this definition control means a the power
direct or indirect to cause the direction or management of such entity whether by contract or otherwise or b
ownership of more than fifty percent 50 of the outstanding shares or beneficial ownership of such entity <<opt:
2 >> license grants and conditions <<opt: 2 1 >> grants each contributor hereby grants you a world wide royalty
free non exclusive license <<opt: a >> under intellectual property rights other than patent or trademark
licensable by such contributor to use reproduce make available modify display perform distribute and otherwise
exploit its contributions either on an unmodified basis with modifications or as part of a larger work and
<<opt: b >> under patent claims of such contributor to make use sell offer for sale have made import and
otherwise transfer either its contributions or its contributor version <<opt: 2 2 >> effective date the licenses
granted in section 2 1 with respect to any contribution become effective for each contribution on the date the
contributor first distributes such contribution <<opt: 2 3 >> limitations on grant scope the licenses granted in
this section 2 are the only rights granted under this license no additional rights or licenses will be implied
from the distribution or licensing of covered software under this license notwithstanding section 2 1 b above no
patent license is granted by a contributor <<opt: a >> for any code that a contributor has removed from covered
software or <<opt: b >> for infringements caused by i your and any other third party s modifications of covered
software or ii the combination of its contributions with other software except as part of its contributor
version or <<opt: c >> under patent claims infringed by covered software in the absence of its contributions
this license does not grant any rights in the trademarks service marks or logos of any contributor except as may
be necessary to comply with the notice requirements in section 3 4 <<opt: 2 4 >> subsequent licenses no
contributor makes additional grants as a result of your choice to distribute the covered software under a
subsequent version of this license see section 10 2 or under the terms of a secondary license if permitted under
the terms of section 3 3 <<opt: 2 5 >> representation each contributor represents that the contributor believes
its contributions are its original creation s or it has sufficient rights to grant the rights to its
contributions conveyed by this license <<opt: 2 6 >> fair use this license is not intended to limit any rights
you have under applicable copyright doctrines of fair use fair dealing or other equivalents <<opt: 2 7 >>
conditions sections 3 1 3 2 3 3 and 3 4 are conditions of the licenses granted in section 2 1 <<opt: 3 >>
responsibilities <<opt: 3 1 >> distribution of source form all distribution of covered software in source code
form including any modifications that you create or to which you contribute must be under the terms of this
license you must inform recipients that the source code form of the covered software is governed by the terms of
this license and how they can obtain a copy of this license you may not attempt to alter or restrict the
recipients rights in the source code form <<opt: 3 2 >> distribution of executable form if you distribute
covered software in executable form then <<opt: a >> such covered software must also be made available in source
code form as described in section 3 1 and you must inform recipients of the executable form how they can obtain
a copy of such source code form by reasonable means in a timely manner at a charge no more than the cost of
distribution to the recipient and <<opt: b >> you may distribute such executable form under the terms of this
license or sublicense it under different terms provided that the license for the executable form does not
attempt to limit or alter the recipients rights in the source code form under this license <<opt: 3 3 >>
distribution of a larger work you may create and distribute a larger work under terms of your choice provided
that you also comply with the requirements of this license for the covered software if the larger work is a
combination of covered software with a work governed by one or more secondary licenses and the covered software
is not incompatible with secondary licenses this license permits you to additionally distribute such covered
software under the terms of such secondary license s so that the recipient of the larger work may at their
option further distribute the covered software under the terms of either this license or such secondary license
s <<opt: 3 4 >> notices you may not remove or alter the substance of any license notices including copyright
notices patent notices disclaimers of warranty or limitations of liability contained within the source code form
of the covered software except that you may alter any license notices to the extent required to remedy known
factual inaccuracies <<opt: 3 5 >> application of additional terms you may choose to offer and to charge a fee
for warranty support indemnity or liability obligations to one or more recipients of covered software however
you may do so only on your own behalf and not on behalf of any contributor you must make it absolutely clear
that any such warranty support indemnity or liability obligation is offered by you alone and you hereby agree to
indemnify every contributor for any liability incurred by such contributor as a result of warranty support
indemnity or liability terms you offer you may include additional disclaimers of warranty and limitations of
liability specific to any jurisdiction <<opt: 4 >> inability to comply due to statute or regulation if it is
impossible for you to comply with any of the terms of this license with respect to some or all of the covered
software due to statute judicial order or regulation then you must a comply with the terms of this license to
the maximum extent possible and b describe the limitations and the code they affect such description must be
placed in a text file included with all distributions of the covered software under this license except to the
extent prohibited by statute or regulation such description must be sufficiently detailed for a recipient of
ordinary skill to be able to understand it <<opt: 5 >> termination <<opt: 5 1 >> the rights granted under this
license will terminate automatically if you fail to comply with any of its terms however if you become compliant
then the rights granted under this license from a particular contributor are reinstated a provisionally unless
and until such contributor explicitly and finally terminates your grants and b on an ongoing basis if such
contributor fails to notify you of the non compliance by some reasonable means prior to 60 days after you have
come back into compliance moreover your grants from a particular contributor are reinstated on an ongoing basis
if such contributor notifies you of the non compliance by some reasonable means this is the first time you have
received notice of non compliance with this license from such contributor and you become compliant prior to 30
days after your receipt of the notice <<opt: 5 2 >> if you initiate litigation against any entity by asserting a
patent infringement claim excluding declaratory judgment actions counter claims and cross claims alleging that a
contributor version directly or indirectly infringes any patent then the rights granted to you by any and all
contributors for the covered software under section 2 1 of this license shall terminate <<opt: 5 3 >> in the
event of termination under sections 5 1 or 5 2 above all end user license agreements excluding distributors and
resellers which have been validly granted by you or your distributors under this license prior to termination
shall survive termination <<opt: 6 >> disclaimer of warranty covered software is provided under this license on
an as is basis without warranty of any kind either expressed implied or statutory including without limitation
warranties that the covered software is free of defects merchantable fit for a particular purpose or non
infringing the entire risk as to the quality and performance of the covered software is with you should any
covered software prove defective in any respect you not any contributor assume the cost of any necessary
servicing repair or correction this disclaimer of warranty constitutes an essential part of this license no use
of any covered software is authorized under this license except under this disclaimer <<opt: 7 >> limitation of
liability under no circumstances and under no legal theory whether tort including negligence contract or
otherwise shall any contributor or anyone who distributes covered software as permitted above be liable to you
for any direct indirect special incidental or consequential damages of any character including without
limitation damages for lost profits loss of goodwill work stoppage computer failure or malfunction or any and
all other commercial damages or losses even if such party shall have been informed of the possibility of such
damages this limitation of liability shall not apply to liability for death or personal injury resulting from
such party s negligence to the extent applicable law prohibits such limitation some jurisdictions do not allow
the exclusion or limitation of incidental or consequential damages so this exclusion and limitation may not
apply to you <<opt: 8 >> litigation any litigation relating to this license may be brought only in the courts of
a jurisdiction where the defendant maintains its principal place of business and such litigation shall be
governed by laws of that jurisdiction without reference to its conflict of law provisions nothing in this
section shall prevent a party s ability to bring cross claims or counter claims <<opt: 9 >> miscellaneous this
license represents the complete agreement concerning the subject matter hereof if any provision of this license
is held to be unenforceable such provision shall be reformed only to the extent necessary to make it enforceable
any law or regulation which provides that the language of a contract shall be construed against the drafter
shall not be used to construe this license against a contributor <<opt: 10 >> versions of the license <<opt: 10
1 >> new versions mozilla foundation is the license steward except as provided in section 10 3 no one other than
the license steward has the right to modify or publish new versions of this license each version will be given a
distinguishing version number <<opt: 10 2 >> effect of new versions you may distribute the covered software
under the terms of the version of the license under which you originally received the covered software or under
the terms of any subsequent version published by the license steward <<opt: 10 3 >> modified versions if you
create software not governed by this license and you want to create a new license for such software you may
create and use a modified version of this license if you rename the license and remove any references to the
name of the license steward except to note that such modified license differs from this license <<opt: 10 4 >>
distributing source code form that is incompatible with secondary licenses if you choose to distribute source
code form that is incompatible with secondary licenses under the terms of this version of the license the notice
described in exhibit b of this license must be attached
"""

#: Label and template of each.
WHOLE = {
    "mit-text": MIT,
    "isc-text": ISC,
    "bsd-2-clause-text": BSD_CONDITIONS + BSD_DISCLAIMER,
    "bsd-3-clause-text": BSD_CONDITIONS + BSD_NAMES + BSD_DISCLAIMER,
    "bsd-4-clause-text": BSD_CONDITIONS + BSD_ADVERTISING + BSD_NAMES + BSD_DISCLAIMER,
    "apache-2.0-text": APACHE_2,
    "mpl-2.0-text": MPL_2,
}
