from .table import TableSpec
from .cdm import CDM_VERSIONS, cdm_spec, cdm_specs
from .psf import PSF_SPECS, STAGED_TABLES, psf_spec
from .vocabulary import VOCABULARY_SPECS

__all__ = [
    "TableSpec", "CDM_VERSIONS", "cdm_spec", "cdm_specs",
    "PSF_SPECS", "STAGED_TABLES", "psf_spec", "VOCABULARY_SPECS",
]
