"""Whole licence texts (fixed values): label -> (mandatory key phrase, text)."""

from __future__ import annotations

TEXTS = {
    "boost-1.0": (
        "covered by this license",
        """Permission is hereby granted, free of charge, to any person or organization obtaining a
        copy of the software and accompanying documentation covered by this license (the
        "Software") to use, reproduce, display, distribute, execute, and transmit the Software,
        and to prepare derivative works of the Software, and to permit third-parties to whom the
        Software is furnished to do so, all subject to the following: The copyright notices in
        the Software and this entire statement, including the above license grant, this
        restriction and the following disclaimer, must be included in all copies of the Software,
        in whole or in part, and all derivative works of the Software, unless such copies or
        derivative works are solely in the form of machine-executable object code generated by a
        source language processor."""),
    "bsd-2-clause": (
        "redistributions of source code must retain the above copyright notice",
        """Redistribution and use in source and binary forms, with or without modification, are
        permitted provided that the following conditions are met: 1. Redistributions of source
        code must retain the above copyright notice, this list of conditions and the following
        disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT
        HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
        LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
        ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY
        DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT
        NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
        PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER
        IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY
        WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
        DAMAGE."""),
    "isc-text": (
        "with or without fee is hereby granted",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or
        without fee is hereby granted, provided that the above copyright notice and this
        permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR
        DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
        MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
        DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS
        OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS
        ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    "zlib": (
        "must not claim that you wrote the original software",
        """This software is provided 'as-is', without any express or implied warranty. In no event
        will the authors be held liable for any damages arising from the use of this software.
        Permission is granted to anyone to use this software for any purpose, including commercial
        applications, and to alter it and redistribute it freely, subject to the following
        restrictions: 1. The origin of this software must not be misrepresented; you must not
        claim that you wrote the original software. If you use this software in a product, an
        acknowledgment in the product documentation would be appreciated but is not required. 2.
        Altered source versions must be plainly marked as such, and must not be misrepresented as
        being the original software. 3. This notice may not be removed or altered from any source
        distribution."""),
}
