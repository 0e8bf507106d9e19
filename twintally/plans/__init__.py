from twintally.plans.run import check_outcome, run_checks
from twintally.plans.spec import CheckSpec, spec_from_mapping

__all__ = ["CheckSpec", "check_outcome", "run_checks", "spec_from_mapping"]
