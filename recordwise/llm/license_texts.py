"""Licence families: their names as notices write them, and opening sentences of their texts.

Fixed values; public licence names and wording.
"""

from __future__ import annotations

NAMES = {
    "MIT": ["MIT License", "MIT license", "MIT/X11 License", "Expat License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache Software License, Version 2.0", "Apache-2.0 license"],
    "BSD": ["BSD License", "3-clause BSD License", "2-clause BSD License", "New BSD License", "BSD-style license", "BSD-3-Clause license"],
    "ISC": ["ISC License", "ISC license"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU General Public License version 2", "GNU GPL v2", "GPL-2.0 license"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License version 3", "GNU GPL v3", "GPL-3.0 license"],
    "LGPL": ["GNU Lesser General Public License", "GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License, version 3", "LGPL license"],
    "AGPL-3.0": ["GNU Affero General Public License", "GNU Affero General Public License, version 3", "AGPL-3.0 license"],
    "MPL-2.0": ["Mozilla Public License, v. 2.0", "Mozilla Public License 2.0", "MPL-2.0 license"],
    "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License, version 2.0"],
    "BSL-1.0": ["Boost Software License, Version 1.0", "Boost Software License 1.0"],
    "CC0-1.0": ["CC0 1.0", "Creative Commons CC0 1.0 Universal", "CC0 1.0 Universal Public Domain Dedication"],
    "CC-BY": ["CC BY 4.0", "CC BY 3.0", "Creative Commons Attribution 4.0 International License", "Creative Commons Attribution License"],
    "CC-BY-SA": ["CC BY-SA 4.0", "CC BY-SA 3.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC": ["CC BY-NC 4.0", "CC BY-NC 3.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-ND": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"],
}

NOTICES = [
    "Licensed under the {}.",
    "Licensed under {}.",
    "Released under the {}.",
    "Released under {}.",
    "Distributed under the {}.",
    "Distributed under the terms of the {}.",
    "This work is licensed under the {}.",
    "This work is licensed under a {}.",
    "This project is licensed under the {}.",
    "This software is released under the {}.",
    "This file is available under the {}.",
    "This program is made available under the terms of the {}.",
    "You may use this work under the {}.",
    "See the {} for details.",
]

TEXTS = {
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "GPL-2.0": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "GPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "LGPL": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation",
    ],
    "AGPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
        "License as published by the Free Software Foundation",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at",
    ],
    "EPL-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at"],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "CC-BY": ["This work is licensed under the Creative Commons Attribution 4.0 International License. To view a copy of this license, visit"],
    "CC-BY-SA": ["This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License. To view a copy of this license, visit"],
    "CC-BY-NC": ["This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License. To view a copy of this license, visit"],
    "CC-BY-ND": ["This work is licensed under the Creative Commons Attribution-NoDerivatives 4.0 International License. To view a copy of this license, visit"],
}

# Paragraphs that speak of licences, rights or terms but grant none of the families.
OTHERS = [
    "All rights reserved.",
    "Copyright reserved by the author.",
    "The driver must carry a valid license at all times.",
    "He lost his driving license for three months.",
    "The license fee is due every year in January.",
    "Licensed to the publisher for one edition only.",
    "This work is confidential and may not be distributed.",
    "The restaurant was licensed to serve wine in public.",
    "Released last summer, the film was made available in general.",
    "The version 2.0 of the program was released in March.",
    "See the manual for details.",
    "The public library is open on Sundays.",
    "A licensed doctor works under the terms of the contract.",
    "You may use this room under the following conditions.",
    "The Apache helicopter was used by the army.",
    "Students of the MIT visited the Boost conference.",
    "Mozilla and Eclipse are names of software projects.",
    "The general public was free to attend; a fee of 4.0 was charged.",
]
