"""Licence texts as published: whole short licences, standard headers, and marked paragraphs of long ones."""

from __future__ import annotations

# List numbers are left out of the BSD conditions, since publishers number them differently.
TEXTS: dict[str, str] = {
    "MIT-full": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        'limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of '
        'the Software, and to permit persons to whom the Software is furnished to do so, subject to the following '
        'conditions: The above copyright notice and this permission notice shall be included in all copies or '
        'substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, '
        'EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR '
        'PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, '
        'DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN '
        'CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
    ),
    "BSD-2-Clause": (
        'Redistribution and use in source and binary forms, with or without modification, are permitted provided that '
        'the following conditions are met: Redistributions of source code must retain the above copyright notice, '
        'this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the '
        'above copyright notice, this list of conditions and the following disclaimer in the documentation and/or '
        'other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND '
        'CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED '
        'WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE '
        'COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR '
        'CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF '
        'USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN '
        'CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF '
        'THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
    ),
    "BSD-3-Clause": (
        'Redistribution and use in source and binary forms, with or without modification, are permitted provided that '
        'the following conditions are met: Redistributions of source code must retain the above copyright notice, '
        'this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the '
        'above copyright notice, this list of conditions and the following disclaimer in the documentation and/or '
        'other materials provided with the distribution. Neither the name of the University nor the names of its '
        'contributors may be used to endorse or promote products derived from this software without specific prior '
        "written permission. THIS SOFTWARE IS PROVIDED BY THE REGENTS AND CONTRIBUTORS ``AS IS'' AND ANY EXPRESS OR "
        'IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR '
        'A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE REGENTS OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, '
        'INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, '
        'PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) '
        'HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING '
        'NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE '
        'POSSIBILITY OF SUCH DAMAGE.'
    ),
    "ISC-full": (
        'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is '
        'hereby granted, provided that the above copyright notice and this permission notice appear in all copies. '
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
        'INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR '
        'ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF '
        'USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF '
        'OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
    ),
    "Unlicense": (
        'This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, '
        'publish, use, compile, sell, or distribute this software, either in source code form or as a compiled '
        'binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize '
        'copyright laws, the author or authors of this software dedicate any and all copyright interest in the '
        'software to the public domain. We make this dedication for the benefit of the public at large and to the '
        'detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in '
        'perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED '
        '"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
        'MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE '
        'LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, '
        'ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
    ),
    "NCSA": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
        'documentation files (the "Software"), to deal with the Software without restriction, including without '
        'limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of '
        'the Software, and to permit persons to whom the Software is furnished to do so, subject to the following '
        'conditions: * Redistributions of source code must retain the above copyright notice, this list of conditions '
        'and the following disclaimers. * Redistributions in binary form must reproduce the above copyright notice, '
        'this list of conditions and the following disclaimers in the documentation and/or other materials provided '
        'with the distribution. * Neither the names of <NAME OF DEVELOPMENT GROUP>, <NAME OF INSTITUTION>, nor the '
        'names of its contributors may be used to endorse or promote products derived from this Software without '
        'specific prior written permission. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS '
        'OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE '
        'AND NONINFRINGEMENT. IN NO EVENT SHALL THE CONTRIBUTORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, '
        'DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN '
        'CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS WITH THE SOFTWARE.'
    ),
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        'compliance with the License. You may obtain a copy of the License at '
        'http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, '
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS '
        'OF ANY KIND, either express or implied. See the License for the specific language governing permissions and '
        'limitations under the License.'
    ),
    "Apache-2.0-grant": (
        'Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, '
        'worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare '
        'Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such '
        'Derivative Works in Source or Object form.'
    ),
    "GPL-2.0-header": (
        'This program is free software; you can redistribute it and/or modify it under the terms of the GNU General '
        'Public License as published by the Free Software Foundation; either version 2 of the License, or (at your '
        'option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY '
        'WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the '
        'GNU General Public License for more details.'
    ),
    "GPL-3.0-header": (
        'This program is free software: you can redistribute it and/or modify it under the terms of the GNU General '
        'Public License as published by the Free Software Foundation, either version 3 of the License, or (at your '
        'option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY '
        'WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the '
        'GNU General Public License for more details.'
    ),
    "LGPL-2.1-header": (
        'This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser '
        'General Public License as published by the Free Software Foundation; either version 2.1 of the License, or '
        '(at your option) any later version. This library is distributed in the hope that it will be useful, but '
        'WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR '
        'PURPOSE. See the GNU Lesser General Public License for more details.'
    ),
    "LGPL-2.0-header": (
        'This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library '
        'General Public License as published by the Free Software Foundation; either version 2 of the License, or (at '
        'your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT '
        'ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See '
        'the GNU Library General Public License for more details.'
    ),
    "LGPL-3.0-header": (
        'This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser '
        'General Public License as published by the Free Software Foundation, either version 3 of the License, or (at '
        'your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT '
        'ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See '
        'the GNU Lesser General Public License for more details.'
    ),
    "AGPL-3.0-header": (
        'This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero '
        'General Public License as published by the Free Software Foundation, either version 3 of the License, or (at '
        'your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT '
        'ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See '
        'the GNU Affero General Public License for more details.'
    ),
    "GPL-2.0-preamble": (
        'The licenses for most software are designed to take away your freedom to share and change it. By contrast, '
        'the GNU General Public License is intended to guarantee your freedom to share and change free software--to '
        'make sure the software is free for all its users. This General Public License applies to most of the Free '
        "Software Foundation's software and to any other program whose authors commit to using it. (Some other Free "
        'Software Foundation software is covered by the GNU Lesser General Public License instead.) You can apply it '
        'to your programs, too.'
    ),
    "GPL-3.0-preamble": (
        'The GNU General Public License is a free, copyleft license for software and other kinds of works. The '
        'licenses for most software and other practical works are designed to take away your freedom to share and '
        'change the works. By contrast, the GNU General Public License is intended to guarantee your freedom to share '
        'and change all versions of a program--to make sure it remains free software for all its users. We, the Free '
        'Software Foundation, use the GNU General Public License for most of our software; it applies also to any '
        'other work released this way by its authors. You can apply it to your programs, too.'
    ),
    "LGPL-3.0-opening": (
        'This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of '
        'the GNU General Public License, supplemented by the additional permissions listed below.'
    ),
    "MPL-2.0-header": (
        'This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL '
        'was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.'
    ),
    "CC0-1.0-waiver": (
        'To the greatest extent permitted by, but not in contravention of, applicable law, Affirmer hereby overtly, '
        "fully, permanently, irrevocably and unconditionally waives, abandons, and surrenders all of Affirmer's "
        'Copyright and Related Rights and associated claims and causes of action, whether now known or unknown '
        '(including existing as well as future claims and causes of action), in the Work (i) in all territories '
        'worldwide, (ii) for the maximum duration provided by applicable law or treaty (including future time '
        'extensions), (iii) in any current or future medium and for any number of copies, and (iv) for any purpose '
        'whatsoever, including without limitation commercial, advertising or promotional purposes (the "Waiver").'
    ),
    "CC-BY-SA-4.0": (
        'This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.'
    ),
    "CC-BY-NC-4.0": (
        'This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.'
    ),
    "CC-BY-SA-4.0-opening": (
        'By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and '
        'conditions of this Creative Commons Attribution-ShareAlike 4.0 International Public License ("Public '
        'License"). To the extent this Public License may be interpreted as a contract, You are granted the Licensed '
        'Rights in consideration of Your acceptance of these terms and conditions, and the Licensor grants You such '
        'rights in consideration of benefits the Licensor receives from making the Licensed Material available under '
        'these terms and conditions.'
    ),
    "EPL-2.0-header": (
        'This program and the accompanying materials are made available under the terms of the Eclipse Public License '
        '2.0 which is available at https://www.eclipse.org/legal/epl-2.0/'
    ),
}
