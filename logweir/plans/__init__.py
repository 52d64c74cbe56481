from logweir.plans.shared import clear_runs, run_folder, shared_dir, stored, within_bound

__all__ = ["clear_runs", "run_folder", "shared_dir", "stored", "within_bound"]
