"""Batch jobs for insurance claim settlement and billing, written as Spark DataFrame plans."""
