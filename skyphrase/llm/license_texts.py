"""Public licence texts and notices that the licence scan knows.

Fixed values: each has a label, a phrase that a file must hold near it, and its text, without names and years.  Of the long
licences these are the notices that files carry, and the openings of the licences' own texts.
"""

from __future__ import annotations

_WARRANTY = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""

_BSD = """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""

_ISC_WARRANTY = """
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""

_GNU = """
This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the
Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details.
You should have received a copy of the GNU {name} along with this program. If not, see <https://www.gnu.org/licenses/>.
"""

_COPY = "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."

_CC = """
Creative Commons {name} 4.0 International Public License
By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this Creative
Commons {name} 4.0 International Public License ("Public License"). To the extent this Public License may be interpreted as a
contract, You are granted the Licensed Rights in consideration of Your acceptance of these terms and conditions, and the Licensor
grants You such rights in consideration of benefits the Licensor receives from making the Licensed Material available under these
terms and conditions.
"""

TEXTS = [
    ("0bsd", "for any purpose with or without fee is hereby granted the software is provided", """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
""" + _ISC_WARRANTY),
    ("agpl", "gnu affero general public license", _GNU.format(name="Affero General Public License")),
    ("agpl", "gnu affero general public license", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 " + _COPY + """
Preamble The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically
designed to ensure cooperation with the community in the case of network server software.
"""),
    ("apache", "apache license version 2 0", """
Apache License Version 2.0, January 2004 http://www.apache.org/licenses/
TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION
1. Definitions.
"License" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this
document.
"Licensor" shall mean the copyright owner or entity authorized by the copyright owner that is granting the License.
"Legal Entity" shall mean the union of the acting entity and all other entities that control, are controlled by, or are under
common control with that entity. For the purposes of this definition, "control" means (i) the power, direct or indirect, to cause
the direction or management of such entity, whether by contract or otherwise, or (ii) ownership of fifty percent (50%) or more of
the outstanding shares, or (iii) beneficial ownership of such entity.
"""),
    ("apache", "apache license version 2 0", """
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License.
"""),
    ("apache", "apache license version 2 0", "Licensed under the Apache License, Version 2.0."),
    ("boost", "documentation covered by this license", """
Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying
documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the
Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do
so, all subject to the following:
The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the
following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the
Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source
language processor.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES
OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR
ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING
FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""),
    ("bsd-2", "source and binary forms", _BSD + _WARRANTY),
    ("bsd-3", "endorse or promote products", _BSD + """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived
from this software without specific prior written permission.
""" + _WARRANTY),
    ("cc-by", "creative commons attribution 4 0", _CC.format(name="Attribution")),
    ("cc-by", "cc by 4 0", "Licensed under CC BY 4.0."),
    ("cc-by", "creative commons attribution 4 0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "creative commons attribution noncommercial", _CC.format(name="Attribution-NonCommercial")),
    ("cc-by-nc", "cc by nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "creative commons attribution noncommercial", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa", "creative commons attribution sharealike", _CC.format(name="Attribution-ShareAlike")),
    ("cc-by-sa", "cc by sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa", "creative commons attribution sharealike", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc0", "waived all copyright", """
To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.
"""),
    ("gpl", "gnu general public license", _GNU.format(name="General Public License")),
    ("gpl", "gnu general public license", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 " + _COPY + """
Preamble The GNU General Public License is a free, copyleft license for software and other kinds of works. The licenses for most
software and other practical works are designed to take away your freedom to share and change the works. By contrast, the GNU
General Public License is intended to guarantee your freedom to share and change all versions of a program--to make sure it remains
free software for all its users.
"""),
    ("gpl", "gnu general public license", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 " + _COPY + """
Preamble The licenses for most software are designed to take away your freedom to share and change it. By contrast, the GNU General
Public License is intended to guarantee your freedom to share and change free software--to make sure the software is free for all
its users. This General Public License applies to most of the Free Software Foundation's software and to any other program whose
authors commit to using it.
"""),
    ("gpl", "gnu general public license", "This work is licensed under the GNU General Public License, version 3."),
    ("isc", "provided that the above copyright notice", """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided
that the above copyright notice and this permission notice appear in all copies.
""" + _ISC_WARRANTY),
    ("lgpl", "gnu lesser general public license", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 " + _COPY + """
This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public
License, supplemented by the additional permissions listed below.
0. Additional Definitions. As used herein, "this License" refers to version 3 of the GNU Lesser General Public License, and the "GNU
GPL" refers to version 3 of the GNU General Public License.
"The Library" refers to a covered work governed by this License, other than an Application or a Combined Work as defined below.
"""),
    ("lgpl", "version of the lesser gpl", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 " + _COPY + """
[This is the first released version of the Lesser GPL. It also counts as the successor of the GNU Library Public License, version 2,
hence the version number 2.1.]
Preamble The licenses for most software are designed to take away your freedom to share and change it.
"""),
    ("lgpl", "gnu lesser general public license", _GNU.format(name="Lesser General Public License")),
    ("mit", "permission is hereby granted free of charge", """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES
OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR
IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""),
    ("mit", "mit license", "Released under the MIT License."),
    ("mpl", "mozilla public license", """
Mozilla Public License Version 2.0
1. Definitions
1.1. "Contributor" means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software.
1.2. "Contributor Version" means the combination of the Contributions of others (if any) used by a Contributor and that particular
Contributor's Contribution.
1.3. "Contribution" means Covered Software of a particular Contributor.
1.4. "Covered Software" means Source Code Form to which the initial Contributor has attached the notice in Exhibit A, the Executable
Form of such Source Code Form, and Modifications of such Source Code Form, in each case including portions thereof.
"""),
    ("mpl", "mozilla public license", """
This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with
this file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""),
    ("unlicense", "unencumbered software", """
This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a
compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in
the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our
heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future
rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES
OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""),
    ("zlib", "held liable for any damages arising", """
This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any
damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use
this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.
"""),
]
