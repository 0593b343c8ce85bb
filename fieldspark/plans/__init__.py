"""The survey jobs, composed from functions and operators."""
