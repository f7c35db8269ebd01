"""Column-level PII masks (pure expressions, stay inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskview.config import EMAIL_MASK_INFIX, SSN_MASK_PREFIX


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mask_ssn(c: Column | str) -> Column:
    """``123-45-6789`` -> ``***-**-6789``; NULL stays NULL."""
    return F.concat(F.lit(SSN_MASK_PREFIX), F.substring(_c(c), 8, 4))


def mask_dob_year(c: Column | str) -> Column:
    """Date of birth generalised to its year, as text (``1975``)."""
    return F.substring(_c(c).cast("string"), 1, 4)


def mask_email(c: Column | str) -> Column:
    """``alice@example.com`` -> ``a***@example.com``.

    ``F.get`` returns NULL for an address without ``@`` where ``[1]`` would
    raise under ANSI mode.
    """
    e = _c(c)
    return F.concat(F.substring(e, 1, 1), F.lit(EMAIL_MASK_INFIX),
                    F.get(F.split(e, "@"), 1))


DEFAULT_MASKS = {"ssn": mask_ssn, "date_of_birth": mask_dob_year,
                 "email": mask_email}
