"""statera: payables aging and account statements as Spark DataFrame jobs."""

from .params import (AgingParams, Bucket, DEFAULT_BUCKETS, FxConfig, G1, G2, PatientOptions, PatientParams,
                     SiteCodes, StatementParams)
from .session import build_session, ensure_checkpoint_dir
from .sources import FinanceTables, derive_tables

__all__ = ["AgingParams", "Bucket", "DEFAULT_BUCKETS", "FxConfig", "G1", "G2", "PatientOptions", "PatientParams",
           "SiteCodes", "StatementParams", "build_session", "ensure_checkpoint_dir", "FinanceTables", "derive_tables"]
