"""What several tests use."""

SF_DIR = "/root/testdata/sf0.001"
#: Words for long texts.
PROSE = "the of and a to in that is was for on are with as his they be at one have this from or had by".split()
