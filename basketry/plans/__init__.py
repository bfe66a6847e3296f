"""Reports, customer segmentation, cohorts, data quality and the end-to-end job."""
