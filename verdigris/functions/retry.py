"""Another attempt at what failed in passing."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from typing import TypeVar

from pyspark.errors import (
    AnalysisException,
    ArithmeticException,
    ArrayIndexOutOfBoundsException,
    DateTimeException,
    IllegalArgumentException,
    NumberFormatException,
    ParseException,
    PythonException,
)

log = logging.getLogger(__name__)
R = TypeVar("R")
#: Failures that the same query or value meets every time.
LASTING = (AnalysisException, ParseException, ArithmeticException, ArrayIndexOutOfBoundsException, DateTimeException, IllegalArgumentException, NumberFormatException, PythonException, ValueError, KeyError, TypeError, NotImplementedError)


def retried(what: Callable[[], R], attempts: int = 3, wait: tuple[float, float] = (2.0, 15.0), sleep: Callable[[float], None] = time.sleep) -> R:
    """what(), again after any failure that may pass, with twice the wait each time, from the first bound up to the second.

    The last failure is raised.  what must be such that doing it twice is doing it once.
    """
    pause = wait[0]
    for left in range(max(1, attempts) - 1, -1, -1):
        try:
            return what()
        except LASTING:
            raise
        except Exception as e:
            if not left:
                raise
            log.warning("%s; %d more attempts, the next in %.0f s", type(e).__name__, left, pause)
            sleep(pause)
            pause = min(2 * pause, wait[1])
    raise AssertionError
