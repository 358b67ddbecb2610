"""Memory of Python workers."""

import subprocess
import sys
from pathlib import Path

import pytest

HELD = """
import re
from hypercube.llm.common import give_back

def held():
    return int(re.findall(r"Pss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())[0]) // 1024

some = [bytes([k % 255 + 1]) * 2000 for k in range(40_000)]
some = some[-1]  # above all that is free now
before = held()
give_back()
print(before - held())
"""


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists(), reason="memory can't be read here")
def test_freed_memory_goes_back_to_the_system():
    found = subprocess.run([sys.executable, "-c", HELD], cwd=Path(__file__).parents[2], capture_output=True, text=True, check=True)
    assert int(found.stdout) > 40
