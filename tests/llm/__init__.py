"""Tests of the operators for training data; a package, so that its modules may be named like those beside it, which import each other by name."""

import os
import sys

sys.path.append(os.path.dirname(os.path.abspath(__file__)))
