from riskview.functions.masking import mask_dob_year, mask_email, mask_ssn
from riskview.functions.metadata import (date_parts, with_ingest_metadata,
                                         with_layer_metadata)

__all__ = ["mask_ssn", "mask_dob_year", "mask_email", "date_parts",
           "with_ingest_metadata", "with_layer_metadata"]
