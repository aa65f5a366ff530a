"""From rules to one logical plan per dataset."""
