"""Reading deliveries and reference tables, writing reports and exports."""
