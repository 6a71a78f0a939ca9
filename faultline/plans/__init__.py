from faultline.plans import alert_run, fleet_report, medallion, policy_run

__all__ = ["alert_run", "fleet_report", "medallion", "policy_run"]
