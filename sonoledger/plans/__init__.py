"""Which recordings and windows still need work, and the jobs that do it."""

from sonoledger.plans.chunk_plan import build_chunk_plan, runnable_plans
from sonoledger.plans.infer_plan import build_infer_plan, incomplete_plans, require_complete
from sonoledger.plans.resume import orphan_counts, pending_jobs, resume_entries, unmatched_entries

__all__ = [
    "build_chunk_plan",
    "build_infer_plan",
    "incomplete_plans",
    "orphan_counts",
    "pending_jobs",
    "require_complete",
    "resume_entries",
    "runnable_plans",
    "unmatched_entries",
]
