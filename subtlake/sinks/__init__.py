"""Writers. Data is written by tasks; the driver only names folders."""
